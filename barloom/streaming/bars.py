"""Structured Streaming forms of bars, upserts and sessions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.sources.tables import upsert


def tumbling_bars(ticks: DataFrame, unit: str = "1 hour", late: str = "2 hours", *, key: str = "key", ts: str = "ts", price: str = "price", volume: str = "volume", tie: Sequence[str] = ()) -> DataFrame:
    """Bars of a stream of ticks; a bar is final when the watermark passes its end. The same on a batch."""
    order = F.struct(ts, *tie)
    bars = ticks.withWatermark(ts, late).groupBy(key, F.window(ts, unit).alias("w")).agg(
        F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, order).alias("close"), F.sum(volume).alias("volume")
    )
    return bars.select(key, F.col("w.start").alias(ts), "open", "high", "low", "close", "volume")


def sliding_sums(ticks: DataFrame, length: str = "24 hours", slide: str = "1 hour", late: str = "2 hours", *, key: str = "key", ts: str = "ts", value: str = "price") -> DataFrame:
    """Sum, mean and count over sliding windows."""
    found = ticks.withWatermark(ts, late).groupBy(key, F.window(ts, length, slide).alias("w")).agg(F.sum(value).alias("total"), F.avg(value).alias("mean"), F.count("*").alias("n"))
    return found.select(key, F.col("w.end").alias(ts), "total", "mean", "n")


def activity_sessions(ticks: DataFrame, gap: str = "2 hours", late: str = "2 hours", *, key: str = "key", ts: str = "ts") -> DataFrame:
    """Sessions that close after a gap without ticks."""
    found = ticks.withWatermark(ts, late).groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count("*").alias("n"))
    return found.select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")


def without_late_copies(rows: DataFrame, keys: Sequence[str], ts: str = "ts", late: str = "7 days") -> DataFrame:
    """One row per key within the watermark."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def _versions(spark: SparkSession, folder: str) -> dict[int, list[int]]:
    """Versions of every bucket in folder, by the names of its directories."""
    top = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found: dict[int, list[int]] = {}
    for x in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "v=*/_bucket=*")) or ():
        version, bucket = (part.split("=")[1] for part in x.getPath().toString().split("/")[-2:])
        found.setdefault(int(bucket), []).append(int(version))
    return found


def upserted(spark: SparkSession, folder: str, below: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The table that upsert_batches() keeps in folder: the newest version (under `below`) of every bucket; None without any."""
    newest = {b: max(own) for b, vs in _versions(spark, folder).items() if (buckets is None or b in buckets) and (own := [v for v in vs if below is None or v < below])}
    paths = [f"{folder}/v={v}/_bucket={b}" for b, v in sorted(newest.items())]
    return spark.read.parquet(*paths) if paths else None


def upsert_batches(folder: str, keys: Sequence[str], order: Sequence[str], buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps an upserted table in folder, in buckets by the hash of the keys.

    Batch n writes version n + 1 of the buckets that it touches, from the newest older versions, and no others; writing it again gives the same, so a replayed
    batch does no harm. Of each bucket the versions before its last but one are deleted. Within a batch the last row by `order` stands for its key.
    """
    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last = batch.groupBy(*keys).agg(F.max_by(F.struct("*"), F.struct(*order)).alias("r")).select("r.*").withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        last = last.persist()
        try:
            touched = [r[0] for r in last.select("_bucket").distinct().collect()]  # at most `buckets` numbers
            if not touched:
                return
            target = upserted(spark, folder, number + 1, touched)
            rows = last.drop("_bucket")
            merged = rows if target is None else upsert(target, rows, keys)
            merged.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).repartition("_bucket").write.partitionBy("_bucket").mode("overwrite").parquet(f"{folder}/v={number + 1}")
        finally:
            last.unpersist()
        for b, versions in _versions(spark, folder).items():
            for v in sorted(versions)[:-2]:
                old = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/v={v}/_bucket={b}")
                old.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(old, True)

    return run


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Drives all available input through foreachBatch and ends."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
