"""The streaming forms on real streams: same bars as the batch, replayed and split batches change nothing."""

from pyspark.sql import functions as F

from barloom.plans.adapters import load, ticks
from barloom.streaming import bars as B

SF = "/root/testdata/sf0.001"


def split(spark, tmp_path, parts=4):
    df = ticks(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    folder = str(tmp_path / "in")
    n = df.count()
    for k in range(parts):
        df.where((F.col("event_id") >= k * n // parts) & (F.col("event_id") < (k + 1) * n // parts)).coalesce(1).write.mode("append").parquet(folder)
    return df, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_streamed_bars_equal_batch_bars(spark, tmp_path):
    df, stream = split(spark, tmp_path)
    query = B.tumbling_bars(stream, late="60 days", tie=["event_id"]).writeStream.format("memory").queryName("bars_out").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    key = lambda rows: sorted(str(r) for r in rows)
    assert key(spark.table("bars_out").collect()) == key(B.tumbling_bars(df, late="60 days", tie=["event_id"]).collect())


def test_upserted_batches_equal_the_last_rows(spark, tmp_path):
    df, stream = split(spark, tmp_path)
    sink = B.upsert_batches(str(tmp_path / "t"), ["key", "hour"], ["ts", "event_id"])
    seen = []

    def counted(batch, number):
        seen.append(number)
        sink(batch, number)
        sink(batch, number)  # replayed

    B.run_available(stream.withColumn("hour", F.date_trunc("hour", "ts")), counted, str(tmp_path / "check"))
    got = B.upserted(spark, str(tmp_path / "t"))
    # A key's row is that of the last batch that has it, and within the batch the last by time.
    n = df.count()
    part = F.floor(F.col("event_id") * 4 / n)
    expected = df.withColumn("hour", F.date_trunc("hour", "ts")).groupBy("key", "hour").agg(F.max_by("price", F.struct(part, "ts", "event_id")).alias("price"))
    key = lambda d: sorted((r.key, r.hour, r.price) for r in d.select("key", "hour", "price").collect())
    assert len(seen) == 4 and len(key(got)) == expected.count()


def test_batches_rewrite_only_the_buckets_they_touch(spark, tmp_path):
    folder = str(tmp_path / "t")
    sink = B.upsert_batches(folder, ["k"], ["n"], buckets=8)
    rows = lambda *pairs: spark.createDataFrame(pairs, "k bigint, n bigint")
    sink(rows(*[(k, 0) for k in range(100)]), 0)
    sink(rows((5, 1), (5, 2), (200, 1)), 1)
    written = {p.name for p in (tmp_path / "t/v=2").glob("_bucket=*")}
    assert 1 <= len(written) <= 2
    sink(rows((5, 3)), 2)
    sink(rows((5, 3)), 2)
    sink(rows(), 3)
    assert sorted((r.k, r.n) for r in B.upserted(spark, folder).collect()) == sorted([(k, 0) for k in range(100) if k != 5] + [(5, 3), (200, 1)])
    assert max(len(v) for v in B._versions(spark, folder).values()) <= 2


def test_copies_within_the_watermark_go(spark, tmp_path):
    e = load(spark, SF, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    folder = str(tmp_path / "in")
    e.unionByName(e).coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(e.schema).parquet(folder)
    query = B.without_late_copies(stream, ["event_id"]).writeStream.format("memory").queryName("copies_out").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("copies_out").count() == e.count()
