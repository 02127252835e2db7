"""Class-ratio undersampling and batch scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.joins import interval_join


def undersample(df: DataFrame, label: str, ids: Sequence[str], positive_share: float = 0.4, buckets: int = 4096) -> DataFrame:
    """The largest subset with the given share of label 1, the rows of each class with the smallest md5 of their ids.

    Only ids, labels and hashes are ranked. Rows are dealt to buckets of the hash's first digits; bucket counts say which buckets are taken whole,
    and ranks are only used within a bucket, so a class is never sorted in one task. Ids must be unique.
    """
    h = F.md5(F.concat_ws("-", *[F.col(c).cast("string") for c in ids]))
    keys = df.where(F.col(label).isin(0, 1)).select(*ids, F.col(label).alias("_y"), h.alias("_h")).withColumn("_b", (F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") % (1 << 32) * buckets / (1 << 32)).cast("int"))
    counts = keys.groupBy("_y", "_b").agg(F.count("*").alias("_n"))
    totals = counts.agg(F.sum(F.when(F.col("_y") == 1, F.col("_n"))).alias("_p"), F.sum(F.when(F.col("_y") == 0, F.col("_n"))).alias("_q"))
    k = F.floor(F.least(F.coalesce("_p", F.lit(0)) / positive_share, F.coalesce("_q", F.lit(0)) / (1 - positive_share)) + 1e-9)
    wanted = totals.select(k.alias("_k")).select(F.explode(F.array(F.struct(F.lit(1).alias("_y"), F.floor(F.col("_k") * positive_share + 1e-9).alias("_want")), F.struct(F.lit(0).alias("_y"), F.floor(F.col("_k") * (1 - positive_share) + 1e-9).alias("_want")))).alias("w")).select("w.*")
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_y").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    room = counts.withColumn("_before", before).join(F.broadcast(wanted), "_y").select("_y", "_b", (F.col("_want") - F.col("_before")).alias("_room")).where("_room > 0")  # two rows are broadcast
    ranked = keys.join(room, ["_y", "_b"]).withColumn("_i", F.row_number().over(Window.partitionBy("_y", "_b").orderBy("_h"))).where(F.col("_i") <= F.col("_room"))
    return df.join(ranked.select(*ids), list(ids), "left_semi")


def probability_of(column: str | Column, label: int = 1) -> Column:
    """Probability of a label in an array of (label, prob); null if it isn't there."""
    c = F.col(column) if isinstance(column, str) else column
    return F.get(F.filter(c, lambda x: x["label"] == label), F.lit(0))["prob"]


def score(df: DataFrame, model, threshold: float = 0.5) -> DataFrame:
    """Scores with a fitted Spark ML pipeline and keeps rows whose probability of label 1 reaches the threshold."""
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(df).withColumn("p1", vector_to_array("probability")[1])
    return scored.where(F.col("p1") >= threshold)


def expand_paths(picks: DataFrame, bars: DataFrame, hours: int = 72, *, key: str = "key", pick_ts: str = "decision_ts", ts: str = "ts", price: str = "price") -> DataFrame:
    """Each pick with its bars of hours 0..hours and a deterministic id for pick and row."""
    pairs = interval_join(picks, bars.select(key, ts, price), key=[key], left_ts=pick_ts, right_ts=ts, low_seconds=0, high_seconds=hours * 3600)
    at = F.unix_seconds(pick_ts)
    h = F.floor((F.unix_seconds(ts) - at) / 3600)
    return pairs.withColumns({"h": h, "pick_id": F.md5(F.concat_ws("-", key, at.cast("string"))), "row_id": F.md5(F.concat_ws("-", key, at.cast("string"), h.cast("string")))})
