"""Trades of a real stream against the batch operator, with bounded state."""

import math

import pytest
from pyspark.sql import functions as F

from barloom.operators import trades as T
from barloom.streaming.trades import trades_stream

SCHEMA = "key string, ts timestamp, close double, high double, low double"


def bars(spark, hours=720):
    rows = []
    for k in range(3):
        for i in range(hours):
            if (i * 13 + k) % 11 == 0:
                continue
            c = 100 + 8 * math.sin(i / 9 + k) + 3 * math.sin(i * 1.7)
            rows.append((f"k{k}", 1_700_000_000 // 3600 * 3600 + 3600 * i, c, c + 1.5, c - 1.2))
    df = spark.createDataFrame(rows, "key string, t bigint, close double, high double, low double")
    return df.select("key", F.timestamp_seconds("t").alias("ts"), "close", "high", "low").cache()


ENTRY, EXIT = "close < 93.5", "close > 104"


@pytest.mark.parametrize(("rule", "target"), [("close", None), ("level", 0.06)])
def test_stream_equals_batch(spark, tmp_path, rule, target):
    df = bars(spark)
    options = {"stop": 0.01, "target": target, "days": 1, "exit_rule": rule}
    first, hours = df.agg(F.min("ts")).first()[0], 720
    chunk = F.floor((F.unix_seconds("ts") - F.unix_seconds(F.lit(first))) / 3600 / (hours / 5))
    for k in range(5):  # in order of time, a file a batch
        df.where(chunk == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for late in (2000, 2001):  # the watermark passes the last day, and a further batch sees it
        far = spark.createDataFrame([("clock", 100.0)], "key string, close double").select("key", F.timestamp_seconds(F.unix_seconds(F.lit(first)) + 3600 * late).alias("ts"), "close", F.col("close").alias("high"), F.col("close").alias("low"))
        far.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = trades_stream(stream, F.expr(ENTRY), F.expr(EXIT), **options).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    expected = T.extract_trades(df, F.expr(ENTRY), F.expr(EXIT), **options)
    plain = lambda d: sorted(str([None if x is None else round(x, 9) if isinstance(x, float) else x for x in r]) for r in d.select(sorted(expected.columns)).collect())
    ended = got.where(F.col("reason").isNotNull())
    assert plain(ended) == plain(expected) and expected.count() > 20 and expected.select("reason").distinct().count() >= 2
    # Entries that don't end are there as well, once each.
    assert got.count() == df.where(ENTRY).count() > ended.count() and got.select("trade_id").distinct().count() == got.count()
    # The state holds bars of about the last days, not all of them: a day and the two batches that a watermark lags behind.
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]
    per_hour = df.count() / hours
    assert held and max(held) < per_hour * (24 + 2 + 2 * hours / 5 + 10) * 2
