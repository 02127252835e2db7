"""Membership carried forward as a stream: weekly inputs in, one row per key and week out, state kept between batches and seeded from a snapshot."""

from __future__ import annotations

import datetime
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barloom.operators.universe import Rules

# The processor runs in tasks and travels by value, so that executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The store that state with timers and initial rows needs.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "key string, week_start date, low_cap_streak bigint, bad_volume_streak bigint, member boolean, entered boolean, exited boolean"
_STATE = "low_cap_streak bigint, bad_volume_streak bigint, member boolean, next_week date"
_WEEK = datetime.timedelta(days=7)


def use_state_store(spark: SparkSession) -> None:
    """Streams of this module keep their state in RocksDB; other settings of the session stay."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _end(week: datetime.date) -> int:
    """Milliseconds of the end of a week, in UTC."""
    return int(datetime.datetime.combine(week + _WEEK, datetime.time(), datetime.timezone.utc).timestamp() * 1000)


class Membership(StatefulProcessor):
    """Of each key: its streaks, whether it is a member, the week that comes next, and inputs that wait for the end of their week.

    A timer at the end of every week takes the weeks that are over, in order; one without input counts as low and bad, as in weekly_inputs(). What comes for a week that has
    been taken is late, or repeats it, and changes nothing.
    """

    def __init__(self, cap_weeks: int, volume_weeks: int):
        self.cap_weeks, self.volume_weeks = cap_weeks, volume_weeks

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", _STATE)
        self.waiting = handle.getMapState("waiting", "week date", "low_cap boolean, bad_volume boolean, meets_entry boolean")

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:
        week = initialState.week_start + _WEEK
        self.state.update((int(initialState.low_cap_streak), int(initialState.bad_volume_streak), bool(initialState.member), week))
        self.handle.registerTimer(_end(week))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        taken = self.state.get()[3] if self.state.exists() else None
        for r in rows:
            if taken is None or r.week_start >= taken:
                self.waiting.updateValue((r.week_start,), (r.low_cap, r.bad_volume, r.meets_entry))
                self.handle.registerTimer(_end(r.week_start))
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.state.exists():
            low, bad, member, week = self.state.get()
        else:
            low, bad, member, week = 0, 0, False, min(k[0] for k in self.waiting.keys())
        while _end(week) <= now:
            low_cap, bad_volume, meets_entry = self.waiting.getValue((week,)) if self.waiting.containsKey((week,)) else (True, True, False)
            self.waiting.removeKey((week,))
            low, bad, before = (low + 1 if low_cap else 0), (bad + 1 if bad_volume else 0), member
            member = not ((low_cap and low >= self.cap_weeks) or (bad_volume and bad >= self.volume_weeks)) if before else meets_entry
            yield Row(key=key[0], week_start=week, low_cap_streak=low, bad_volume_streak=bad, member=member, entered=member and not before, exited=before and not member)
            week += _WEEK
        self.state.update((low, bad, member, week))
        self.handle.registerTimer(_end(week))


def membership_stream(inputs: DataFrame, rules: Rules = Rules(), seed: DataFrame | None = None, late: str = "0 days", key: str = "key") -> DataFrame:
    """membership_state() over a stream of weekly inputs (key, week_start, low_cap, bad_volume, meets_entry): rows are appended once a week is over by the watermark.

    seed has the last frozen week of each key: (key, week_start, low_cap_streak, bad_volume_streak, member); weeks up to it are never written again. Keys come out as
    strings. Weeks begin on one day of the week, in UTC. The session's state store must be use_state_store()'s.
    """
    rows = inputs.select(F.col(key).cast("string").alias("key"), "week_start", "low_cap", "bad_volume", "meets_entry", F.col("week_start").cast("timestamp").alias("at")).withWatermark("at", late)
    start = None if seed is None else seed.select(F.col(key).cast("string").alias("key"), "week_start", "low_cap_streak", "bad_volume_streak", "member").groupBy("key")
    return rows.groupBy("key").transformWithState(Membership(rules.cap_weeks, rules.volume_weeks), OUT, "Append", "EventTime", initialState=start)
