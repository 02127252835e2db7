"""Writes that are checked while they run: all checks are metrics of the pass that writes, and a version is only published if they hold."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class CheckFailed(ValueError):
    """A batch that wasn't published; found has what each broken check has measured."""

    def __init__(self, found: Mapping[str, object]):
        super().__init__(", ".join(f"{k}: {v}" for k, v in found.items()))
        self.found = dict(found)


# Row-wise rules as violations, for write_checked(rows=...).
def null_in(*columns: str) -> Column:
    return F.greatest(*[F.col(c).isNull() for c in columns]) if len(columns) > 1 else F.col(columns[0]).isNull()


def due_to_leave(cap_weeks: int = 2, volume_weeks: int = 4) -> Column:
    """A member whose streaks say that it should have left, or an exit without a reason."""
    due = (F.col("low_cap_streak") >= cap_weeks) | (F.col("bad_volume_streak") >= volume_weeks)
    return (F.col("member") & due & ~F.col("entered")) | (F.col("exited") & ~due)


def looks_ahead(used_until: str, week: str = "week_start") -> Column:
    """Data from the row's own week or later."""
    return F.col(used_until) >= F.col(week).cast("timestamp")


def _fs(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _versions(spark: SparkSession, path: str) -> list[int]:
    pattern, fs = _fs(spark, f"{path}/v=*")
    return sorted(int(x.getPath().getName().split("=")[1]) for x in fs.globStatus(pattern) or ())


def published(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest published version of the table in path; None before the first."""
    versions = _versions(spark, path)
    return spark.read.parquet(f"{path}/v={versions[-1]}") if versions else None


def write_checked(df: DataFrame, path: str, rows: Mapping[str, Column] | None = None, totals: Mapping[str, tuple[Column, float | None, float | None]] | None = None, cluster: Sequence[str] = (), keep: int = 2) -> dict[str, object]:
    """Writes df as the next version of the table in path, if all checks hold, and returns what they measured; else raises CheckFailed and leaves the table as it is.

    rows are violations, which no row may show (null is none). totals are aggregates with bounds, of which None is open; a null aggregate is outside of any bound. All of them are
    metrics of the one pass that writes. A version is written aside and published by one rename, so that readers see the old table or the new one; `keep` versions stay.
    Metrics may count a task twice that runs twice, which can only make a check fail that would have held, or move a total: a violation is never missed.
    """
    spark, rows, totals = df.sparkSession, dict(rows or {}), dict(totals or {})
    seen = Observation()
    metrics = [F.count("*").alias("rows"), *[F.count_if(F.coalesce(x, F.lit(False))).alias(f"bad_{n}") for n, x in rows.items()], *[x.alias(f"total_{n}") for n, (x, _, _) in totals.items()]]
    out = df.observe(seen, *metrics)
    aside = f"{path}/_aside-{uuid.uuid4().hex}"
    (out.sortWithinPartitions(*cluster) if cluster else out).write.parquet(aside)
    found = seen.get
    broken = {n: found[f"bad_{n}"] for n in rows if found[f"bad_{n}"]}
    for n, (_, low, high) in totals.items():
        value = found[f"total_{n}"]
        if value is None or (low is not None and value < low) or (high is not None and value > high):
            broken[n] = value
    source, fs = _fs(spark, aside)
    if broken:
        fs.delete(source, True)
        raise CheckFailed(broken)
    versions = _versions(spark, path)
    target, _ = _fs(spark, f"{path}/v={versions[-1] + 1 if versions else 0}")
    if not fs.rename(source, target):
        raise OSError(f"{target.toString()} couldn't be published")
    for old in [*versions, -1][: max(0, len(versions) + 1 - keep)]:
        if old >= 0:
            fs.delete(_fs(spark, f"{path}/v={old}")[0], True)
    return {"rows": found["rows"], **{n: found[f"bad_{n}"] for n in rows}, **{n: found[f"total_{n}"] for n in totals}}
