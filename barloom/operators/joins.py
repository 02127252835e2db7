"""Joins over time: intervals, as-of, splices, overrides, reconciliation and priorities."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interval_join(left: DataFrame, right: DataFrame, *, key: Sequence[str], left_ts: str, right_ts: str, low_seconds: int, high_seconds: int, low_open: bool = False, how: str = "inner", bucket_seconds: int | None = None) -> DataFrame:
    """Pairs with right_ts - left_ts in [low, high] seconds (open below with low_open) on equal keys.

    Each left row is copied to the time buckets that its interval touches and meets right rows of the same key and bucket only, so a key with
    many rows isn't compared as a whole. Columns other than the key must differ in name. how is "inner" or "left".
    """
    size = bucket_seconds or max(1, high_seconds - low_seconds)
    at = F.unix_seconds(left_ts)
    bucket = lambda x: F.floor(x / size)
    fanned = left.withColumn("_bucket", F.explode(F.sequence(bucket(at + low_seconds), bucket(at + high_seconds))))
    placed = right.withColumn("_bucket", bucket(F.unix_seconds(right_ts)))
    apart = F.unix_seconds(right_ts) - F.unix_seconds(left_ts)
    near = (apart > low_seconds) if low_open else (apart >= low_seconds)
    pairs = fanned.join(placed, [*key, "_bucket"]).where(near & (apart <= high_seconds)).drop("_bucket")
    if how == "inner":
        return pairs
    if how != "left":
        raise ValueError("how is 'inner' or 'left'")
    found = pairs.select(*[F.col(c).alias(f"_{c}") for c in left.columns]).distinct()
    alone = left.join(found, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in left.columns]), "left_anti")
    return pairs.unionByName(alone, allowMissingColumns=True)


def asof_join(left: DataFrame, right: DataFrame, *, key: Sequence[str], left_ts: str, right_ts: str, strict: bool = False, tie: Sequence[str] = ()) -> DataFrame:
    """Every left row with the columns of the latest right row of its key at or (strict) before its time; null where there is none.

    One union and one window: no row is compared with another. Right rows of one time are ordered by the tie columns, the last wins.
    """
    columns = [c for c in right.columns if c not in key]
    side = F.lit(0 if not strict else 1)
    a = left.select(F.struct("*").alias("_left"), *key, F.col(left_ts).alias("_at"), (1 - side).alias("_side"))
    b = right.select(F.struct(*columns).alias("_right"), *key, F.col(right_ts).alias("_at"), side.alias("_side"), *[F.col(c).alias(f"_tie{k}") for k, c in enumerate(tie)])
    w = Window.partitionBy(*key).orderBy("_at", "_side", *[f"_tie{k}" for k in range(len(tie))]).rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b, allowMissingColumns=True).withColumn("_found", F.last("_right", ignorenulls=True).over(w)).where(F.col("_left").isNotNull())
    return both.select("_left.*", *[F.col(f"_found.{c}").alias(c) for c in columns])


def splice(history: DataFrame, live: DataFrame, ts: str = "ts") -> DataFrame:
    """All of history, and live rows after its last time."""
    last = history.agg(F.max(ts).alias("_last"))  # one row
    later = live.crossJoin(F.broadcast(last)).where(F.col("_last").isNull() | (F.col(ts) > F.col("_last"))).drop("_last")
    return history.unionByName(later)


def apply_overrides(df: DataFrame, overrides: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Non-null values of overrides replace those of df on equal keys."""
    renamed = overrides.select(*keys, *[F.col(c).alias(f"_{c}") for c in columns])
    return df.join(renamed, list(keys), "left").select(*[F.coalesce(f"_{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns])


def reconcile(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows that differ, with both values and a reason: missing_left, missing_right or the first column that differs."""
    x = a.select(*keys, *[F.col(c).alias(f"{c}_left") for c in columns], F.lit(True).alias("_l"))
    y = b.select(*keys, *[F.col(c).alias(f"{c}_right") for c in columns], F.lit(True).alias("_r"))
    both = x.join(y, list(keys), "full")
    reason = F.when(F.col("_l").isNull(), "missing_left").when(F.col("_r").isNull(), "missing_right")
    for c in columns:
        reason = reason.when(~F.col(f"{c}_left").eqNullSafe(F.col(f"{c}_right")), c)
    return both.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("_l", "_r")


def prefer(sources: Iterable[DataFrame], keys: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Union of sources in order of priority, one row per keys: from the first source that has it."""
    ranked = reduce(DataFrame.unionByName, [d.withColumn("_priority", F.lit(k)) for k, d in enumerate(sources)])
    w = Window.partitionBy(*keys).orderBy("_priority", *tie)
    return ranked.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_priority")


def backfill(primary: DataFrame, secondary: DataFrame, key: Sequence[str]) -> DataFrame:
    """All of primary, and rows of secondary whose key primary lacks."""
    return primary.unionByName(secondary.join(primary.select(*key), list(key), "left_anti"))


def star(base: DataFrame, blocks: Iterable[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Left joins of feature blocks on their keys, one after the other."""
    return reduce(lambda d, b: d.join(b[0], list(b[1]), "left"), blocks, base)


def next_event(df: DataFrame, flag: Column, *, key: Sequence[str], ts: str, name: str = "next_ts") -> DataFrame:
    """Time of the first later row of the key where flag holds: a running minimum from the end, as a frame that is open towards the future would be scanned anew for each row."""
    w = Window.partitionBy(*key).orderBy(F.desc(ts)).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.min(F.when(flag, F.col(ts))).over(w))


def weeks_served(bars: DataFrame, ts: str = "ts", days: int = 30, name: str = "week_start") -> DataFrame:
    """Each bar once for every Monday in (ts, ts + days]: an equi grouping in place of a join on a range of weeks."""
    mondays = F.expr(f"sequence(date_trunc('week', {ts}) + interval 7 days, date_trunc('week', {ts} + interval {days} days), interval 7 days)")
    possible = F.expr(f"date_trunc('week', {ts}) + interval 7 days <= date_trunc('week', {ts} + interval {days} days)")
    return bars.where(possible).withColumn(name, F.explode(mondays)).withColumn(name, F.to_date(name))


def leaders_returns(base: DataFrame, edges: DataFrame, *, key: str = "key", ts: str = "ts", leader: str = "leader", run: str = "run_ts", value: str = "ret") -> DataFrame:
    """Mean value and count of a key's leaders at the same time, by the latest edge list strictly before the row's day."""
    runs = edges.select(key, run).distinct()
    dated = asof_join(base.select(key, ts).withColumn("_day", F.date_trunc("day", ts)), runs.withColumn("_run", F.col(run)).select(key, run, "_run"), key=[key], left_ts="_day", right_ts=run, strict=True)
    hops = dated.where(F.col("_run").isNotNull()).select(key, ts, F.col("_run").alias(run)).join(edges, [key, run])
    others = base.select(F.col(key).alias(leader), ts, F.col(value).alias("_value"))
    means = hops.join(others, [leader, ts]).groupBy(key, ts).agg(F.avg("_value").alias("leader_mean"), F.count("_value").alias("leader_count"))
    return base.join(means, [key, ts], "left")


def union_entities(entities: Mapping[str, DataFrame], name: str = "entity") -> DataFrame:
    """Entities under each other by column name, each tagged; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [d.withColumn(name, F.lit(k)) for k, d in entities.items()])
