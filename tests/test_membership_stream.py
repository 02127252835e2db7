"""The membership stream against the batch fold: in one go, after a restart, with weeks that repeat, and from a snapshot."""

import datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import universe as U
from barloom.streaming import membership as M

RULES = U.Rules(cap_weeks=2, volume_weeks=3)
FIRST = datetime.date(2024, 1, 1)
COLUMNS = ("key", "week_start", "low_cap_streak", "bad_volume_streak", "member", "entered", "exited")


def inputs(spark, weeks=14):
    """Keys that enter, leave by either streak, come back, miss weeks and begin late."""
    rows = []
    for k in range(7):
        for i in range(k % 3, weeks):
            if k >= 4 and (i * 7 + k) % 5 == 0:
                continue  # no input this week
            rows.append((f"k{k}", FIRST + datetime.timedelta(days=7 * i), (i + k) % (3 + k % 3) < 2 if k else False, (i * k) % 7 < 3, (i + 2 * k) % 4 != 0))
    return spark.createDataFrame(rows, "key string, week_start date, low_cap boolean, bad_volume boolean, meets_entry boolean")


def filled(spark, df, seed=None):
    """Every week of every key from its first on, up to the last of all, as weekly_inputs() gives them."""
    last = df.agg(F.max("week_start")).first()[0]
    first = df.groupBy("key").agg(F.min("week_start").alias("first"))
    if seed is not None:
        first = first.join(seed.select("key", F.date_add("week_start", 7).alias("s")), "key", "full").select("key", F.coalesce("s", "first").alias("first"))
    grid = first.select("key", F.explode(F.sequence("first", F.lit(last), F.expr("interval 7 days"))).alias("week_start"))
    rows = grid.join(df, ["key", "week_start"], "left")
    return rows.select("key", "week_start", *[F.coalesce(c, F.lit(v)).alias(c) for c, v in (("low_cap", True), ("bad_volume", True), ("meets_entry", False))])


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def drive(spark, tmp_path, seed=None):
    stream = spark.readStream.schema("key string, week_start date, low_cap boolean, bad_volume boolean, meets_entry boolean").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = M.membership_stream(stream, RULES, seed)
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(M.OUT).parquet(str(tmp_path / "out"))


def put(df, tmp_path):
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


@pytest.fixture
def store(spark):
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    M.use_state_store(spark)
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)


def week(i):
    return FIRST + datetime.timedelta(days=7 * i)


def test_stream_equals_batch_also_after_a_restart_and_a_replay(spark, tmp_path, store):
    df = inputs(spark).cache()
    expected = rows_of(U.membership_state(filled(spark, df), rules=RULES))
    for i in range(0, 6, 2):
        put(df.where((F.col("week_start") >= week(i)) & (F.col("week_start") < week(i + 2))), tmp_path)
    some = rows_of(drive(spark, tmp_path))
    assert some and set(some) < set(expected)
    # Restarted: old weeks again, then the rest.
    put(df.where(F.col("week_start") < week(3)), tmp_path)
    for i in range(6, 14, 2):
        put(df.where((F.col("week_start") >= week(i)) & (F.col("week_start") < week(i + 2))), tmp_path)
    put(spark.createDataFrame([("clock", week(15), False, False, False)], df.schema), tmp_path)  # the watermark passes the last week
    got = [r for r in rows_of(drive(spark, tmp_path)) if r[0] != "clock" and r[1] <= week(13)]
    assert got == expected
    assert {r[4] for r in got} == {True, False} and any(r[5] for r in got) and any(r[6] for r in got)


def test_stream_from_a_snapshot(spark, tmp_path, store):
    df = inputs(spark).cache()
    whole = U.membership_state(filled(spark, df), rules=RULES)
    seed = whole.where(F.col("week_start") == week(5)).select("key", "week_start", "low_cap_streak", "bad_volume_streak", "member").cache()
    put(df.where(F.col("week_start") < week(10)), tmp_path)  # weeks up to the snapshot are history
    put(df.where(F.col("week_start") >= week(10)), tmp_path)
    put(spark.createDataFrame([("clock", week(15), False, False, False)], df.schema), tmp_path)
    got = [r for r in rows_of(drive(spark, tmp_path, seed)) if r[0] != "clock" and r[1] <= week(13)]
    assert got == rows_of(whole.where(F.col("week_start") > week(5)))
