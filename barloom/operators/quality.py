"""Data-quality checks: each returns the rows that violate it, none when all is well."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.expr import safe_div
from barloom.operators.cross import over_time


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which one of the columns is null, with the names of those."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("null_columns", missing).where(F.size("null_columns") > 0)


def member_count_band(state: DataFrame, low: int, high: int, most_contraction: float = 0.2, week: str = "week_start") -> DataFrame:
    """Weeks whose member count leaves the band or shrinks by more than most_contraction."""
    counts = state.groupBy(week).agg(F.count_if("member").alias("members")).withColumn("before", F.lag("members").over(over_time(week)))
    shrinks = F.coalesce(F.col("members") < (1 - most_contraction) * F.col("before"), F.lit(False))
    return counts.where(~F.col("members").between(low, high) | shrinks)


def hysteresis(state: DataFrame, cap_weeks: int = 2, volume_weeks: int = 4) -> DataFrame:
    """Members whose streaks say that they should have left, and exits without a reason."""
    due = (F.col("low_cap_streak") >= cap_weeks) | (F.col("bad_volume_streak") >= volume_weeks)
    return state.where((F.col("member") & due & ~F.col("entered")) | (F.col("exited") & ~due))


def cap_respected(state: DataFrame, most: int, week: str = "week_start") -> DataFrame:
    """Weeks with more than `most` members."""
    return state.groupBy(week).agg(F.count_if("member").alias("members")).where(F.col("members") > most)


def no_look_ahead(inputs: DataFrame, used_until: str, week: str = "week_start") -> DataFrame:
    """Rows that used data from their own week or later."""
    return inputs.where(F.col(used_until) >= F.col(week).cast("timestamp"))


def single_version(state: DataFrame, columns: Sequence[str], week: str = "week_start") -> DataFrame:
    """Weeks with more than one value of a version column."""
    return state.groupBy(week).agg(*[F.countDistinct(c).alias(f"n_{c}") for c in columns]).where(reduce(lambda a, b: a | b, [F.col(f"n_{c}") > 1 for c in columns]))


def turnover(state: DataFrame, most: float = 0.1, week: str = "week_start") -> DataFrame:
    """Weeks in which entries and exits are more than `most` of the members before."""
    counts = state.groupBy(week).agg(F.count_if("member").alias("members"), F.count_if("entered").alias("entered"), F.count_if("exited").alias("exited"))
    counts = counts.withColumn("before", F.lag("members").over(over_time(week)))
    return counts.withColumn("turnover", safe_div(F.col("entered") + F.col("exited"), "before")).where(F.col("turnover") > most)


def excluded_present(members: DataFrame, excluded: DataFrame, key: str = "key") -> DataFrame:
    """Members that belong to an excluded class."""
    return members.where("member").join(excluded.select(key), key, "left_semi")


def pool_floor(metrics: DataFrame, least_keys: int, least_bars: int, week: str = "week_start") -> DataFrame:
    """Weeks with fewer than least_keys keys of least_bars bars."""
    return metrics.groupBy(week).agg(F.count_if(F.col("trailing_bars") >= least_bars).alias("pool")).where(F.col("pool") < least_keys)


def count_consistent(df: DataFrame, stated: str, ts: str = "ts") -> DataFrame:
    """Times at which a stated count isn't the same in all rows, or isn't the number of rows."""
    return df.groupBy(ts).agg(F.count("*").alias("rows"), F.min(stated).alias("low"), F.max(stated).alias("high")).where((F.col("low") != F.col("high")) | (F.col("rows") != F.col("high")))


def complete_hours(df: DataFrame, expected: DataFrame, least_share: float = 0.9, ts: str = "ts") -> DataFrame:
    """Expected times (ts, expected) that have fewer than least_share of their rows."""
    seen = df.groupBy(ts).agg(F.count("*").alias("present"))
    return expected.join(seen, ts, "left").withColumn("present", F.coalesce("present", F.lit(0))).where(F.col("present") < least_share * F.col("expected"))


def only_members(df: DataFrame, members: DataFrame, key: str = "key", ts: str = "ts") -> DataFrame:
    """Rows of keys that aren't members in their week."""
    week = F.to_date(F.date_trunc("week", ts))
    return df.withColumn("week_start", week).join(members.where("member").select(key, "week_start"), [key, "week_start"], "left_anti")


def review_candidates(snapshots: DataFrame, suspicious: Column, key: str = "key", ts: str = "ts", known: DataFrame | None = None) -> DataFrame:
    """Latest snapshot of every key that looks suspicious and isn't on the known list."""
    w = Window.partitionBy(key).orderBy(F.desc(ts))
    latest = snapshots.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").where(suspicious)
    return latest if known is None else latest.join(known.select(key), key, "left_anti")


def report(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check_name, failing_rows, checked_rows) of boolean conditions that must hold where they aren't null; one pass over df."""
    row = df.agg(F.count("*").alias("_n"), *[F.count_if(~c).alias(name) for name, c in checks.items()])
    return row.select("_n", F.explode(F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(name).alias("failing_rows")) for name in checks])).alias("c")).select("c.check_name", "c.failing_rows", F.col("_n").alias("checked_rows"))


def rank_correlation(df: DataFrame, x: str, y: str, ts: str = "ts") -> DataFrame:
    """Spearman correlation per time, by percent ranks."""
    ranks = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumns({f"_{c}": F.percent_rank().over(Window.partitionBy(ts).orderBy(c)) for c in (x, y)})
    spread = F.stddev_pop(f"_{x}") * F.stddev_pop(f"_{y}")
    return ranks.groupBy(ts).agg(F.when(spread > 1e-15, F.covar_pop(f"_{x}", f"_{y}") / spread).alias("rank_corr"), F.count("*").alias("n"))


def varies_within_time(df: DataFrame, columns: Sequence[str], ts: str = "ts") -> DataFrame:
    """Times at which a column that should be one value for all keys has several."""
    spread = df.groupBy(ts).agg(*[F.countDistinct(c).alias(c) for c in columns])
    return spread.where(reduce(lambda a, b: a | b, [F.col(c) > 1 for c in columns]))
