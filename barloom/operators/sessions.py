"""Monitoring sessions of one series per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.rolling import S, Series


def _numbered(df: DataFrame, s: Series) -> DataFrame:
    """session: number of the run of rows where `monitored` holds, null elsewhere."""
    starts = F.col("monitored") & ~F.coalesce(F.lag("monitored").over(s.ordered), F.lit(False))
    df = df.withColumn("_start", F.when(starts, 1).otherwise(0))
    return df.withColumn("session", F.when(F.col("monitored"), F.sum("_start").over(s.past))).drop("_start")


def sessionize(df: DataFrame, flag: Column, hold_seconds: int = 172_800, s: Series = S) -> DataFrame:
    """monitored: flag held within the last hold_seconds; session numbers the runs."""
    df = df.withColumn("_flag", F.when(flag, 1).otherwise(0))
    return _numbered(df.withColumn("monitored", F.max("_flag").over(s.seconds(hold_seconds)) == 1).drop("_flag"), s)


def sessionize_until_local_hour(df: DataFrame, flag: Column, hour: int = 7, zone: str = "Europe/Paris", s: Series = S) -> DataFrame:
    """monitored while flag holds, and after it drops until the next `hour` o'clock in zone; session numbers the runs."""
    w = s.ordered
    df = df.withColumn("_flag", F.when(flag, 1).otherwise(0))
    drops = (F.col("_flag") == 0) & (F.coalesce(F.lag("_flag").over(w), F.lit(0)) == 1)
    df = df.withColumn("_drop", F.last(F.when(drops, F.col(s.ts)), ignorenulls=True).over(s.past))
    local = F.from_utc_timestamp("_drop", zone)
    day = F.when(F.hour(local) < hour, F.to_date(local)).otherwise(F.date_add(F.to_date(local), 1))
    until = F.to_utc_timestamp(F.to_timestamp(day) + F.expr(f"INTERVAL {hour} HOURS"), zone)
    df = df.withColumn("monitored", (F.col("_flag") == 1) | (F.col("_drop").isNotNull() & (F.col(s.ts) < until)))
    return _numbered(df.drop("_flag", "_drop"), s)


def extend_sessions(df: DataFrame, back_days: int = 7, ahead_days: int = 7, s: Series = S) -> DataFrame:
    """Every row near a session once, with the session's bounds, its extension and in_pre, in_core, in_post.

    A row that the extensions of several sessions hold goes to the one it is part of, else to the nearest, else to the first.
    """
    bounds = df.where(F.col("session").isNotNull()).groupBy(s.key, "session").agg(F.min(s.ts).alias("session_start"), F.max(s.ts).alias("session_end"))
    bounds = bounds.withColumn("_b", F.struct(F.col("session").alias("of_session"), "session_start", "session_end", (F.col("session_start") - F.expr(f"INTERVAL {back_days} DAYS")).alias("extended_start"), (F.col("session_end") + F.expr(f"INTERVAL {ahead_days} DAYS")).alias("extended_end")))
    # Sessions are runs of rows, so a row outside them has its nearest ones just before and after it: two windows, one from either end, and no row meets all sessions of its key.
    at, w = F.col(s.ts), Window.partitionBy(s.key)
    rows = df.join(bounds.select(s.key, "session", "_b"), [s.key, "session"], "left")
    rows = rows.withColumns({"_before": F.last("_b", ignorenulls=True).over(w.orderBy(s.ts).rangeBetween(Window.unboundedPreceding, 0)), "_after": F.last("_b", ignorenulls=True).over(w.orderBy(F.desc(s.ts)).rangeBetween(Window.unboundedPreceding, 0))})
    since, until = F.unix_seconds(s.ts) - F.unix_seconds("_before.session_end"), F.unix_seconds("_after.session_start") - F.unix_seconds(s.ts)
    near = F.when(at <= F.col("_before.extended_end"), since), F.when(at >= F.col("_after.extended_start"), until)
    chosen = F.when(F.col("_b").isNotNull(), F.col("_b")).when(near[0].isNotNull() & (near[1].isNull() | (near[0] <= near[1])), F.col("_before")).when(near[1].isNotNull(), F.col("_after"))
    rows = rows.withColumn("_b", chosen).where(F.col("_b").isNotNull()).select(*[c for c in df.columns if c != "session"], "_b.*")
    rows = rows.withColumns({"in_pre": at < F.col("session_start"), "in_core": at.between(F.col("session_start"), F.col("session_end")), "in_post": at > F.col("session_end")})
    return rows.withColumnRenamed("of_session", "session")
