"""SQL table functions against the Python operators."""

import datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import bars as B
from barloom.operators import cross as X
from barloom.operators import rolling as R
from barloom.plans.adapters import ticks
from barloom.sql import create_functions

SF = "/root/testdata/sf0.001"
COLUMNS = ["mean_24", "std_24", "rv_24", "cumret_24", "cumret_168", "dist_sma_24", "dist_sma_168", "dist_high_168"]
AS_OF = datetime.datetime(2024, 1, 20, 5)


@pytest.fixture(scope="module")
def source(spark):
    df = ticks(spark, SF).withColumn("ts", F.col("ts").cast("timestamp")).cache()
    df.createOrReplaceTempView("ticks")
    weeks = df.where("key <> 'error'").select("key", F.to_date(F.date_trunc("week", "ts")).alias("week_start")).distinct().withColumn("member", F.lit(True))
    weeks.createOrReplaceTempView("membership")
    create_functions(spark, tie=("event_id",))
    return df, weeks


def plain(df, columns):
    return sorted(str([round(x, 9) + 0.0 if isinstance(x, float) else x for x in r]) for r in df.select(columns).collect())


def features(df):
    grid = B.fill_grid(B.resample_bars(df, "hour", tie=["event_id"]).withColumnRenamed("close", "price"))
    out = R.moving_averages(R.returns(grid), (24, 168), macd=None, spread=None)
    return R.next_bar(R.extremes(R.cumulative_return(R.realized_vol(R.mean_std(out, (24,)), (24,))), (168,)))


@pytest.mark.parametrize("hours", [None, 240])
def test_bars(spark, source, hours):
    df, _ = source
    part = df if hours is None else df.where((F.col("ts") < F.lit(AS_OF)) & (F.col("ts") >= F.lit(AS_OF - datetime.timedelta(hours=hours))))
    call = "hourly_bars()" if hours is None else f"hourly_bars(as_of => TIMESTAMP '{AS_OF}', history_hours => {hours})"
    names = ["key", "ts", "open", "high", "low", "close", "volume"]
    got = plain(spark.sql(f"SELECT * FROM {call}"), names)
    assert got == plain(B.resample_bars(part, "hour", tie=["event_id"]), names) and got


def test_features(spark, source):
    df, _ = source
    names = ["key", "ts", "price", "volume", "ret", *COLUMNS, "next_price"]
    assert plain(spark.sql("SELECT * FROM asset_features()"), names) == plain(features(df), names)
    part = df.where((F.col("ts") < F.lit(AS_OF)) & (F.col("ts") >= F.lit(AS_OF - datetime.timedelta(hours=300))))
    got = plain(spark.sql(f"SELECT * FROM asset_features(TIMESTAMP '{AS_OF}', 300, 48)"), names)
    assert got == plain(features(part).where(F.col("ts") >= F.lit(AS_OF - datetime.timedelta(hours=48))), names) and 0 < len(got) <= 5 * 48


@pytest.mark.parametrize("edge", [True, False])
def test_serving(spark, source, edge):
    df, weeks = source
    f = features(df)
    stats = f.groupBy("ts").agg(F.count("*").alias("univ_n"), F.avg("cumret_24").alias("univ_mean_short"), F.avg(F.when(F.col("cumret_24") > 0, 1.0).otherwise(0.0)).alias("univ_share_up"))
    names = ["key", "ts", "price", *COLUMNS, "univ_n", "univ_mean_short", "univ_share_up", "member"]
    expected = plain(X.serving_contract(f, stats, [], weeks, members_only=True, include_edge=edge), names)
    got = plain(spark.sql(f"SELECT * FROM inference_features(include_edge => {str(edge).lower()})"), names)
    assert got == expected and got and not any("'error'" in r for r in got)
    everyone = spark.sql("SELECT * FROM inference_features(members_only => false)")
    assert everyone.count() == f.count() and {r[0] for r in everyone.select("member").distinct().collect()} == {True, False}


def test_filters_reach_the_scan(spark, tmp_path):
    ticks(spark, SF).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "t"))
    spark.read.parquet(str(tmp_path / "t")).createOrReplaceTempView("stored_ticks")
    create_functions(spark, ticks="stored_ticks", membership=None, tie=("event_id",))
    try:
        plan = spark.sql(f"SELECT key, close FROM hourly_bars(TIMESTAMP '{AS_OF}', 48)")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    finally:
        create_functions(spark, tie=("event_id",)) if spark.catalog.tableExists("membership") else None
