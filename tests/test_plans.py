"""Plans that must hold at any size: how often queries read their tables, and no frame that is open towards the future."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barloom.operators import joins as J
from barloom.plans import events, sections, series, tables  # noqa: F401
from barloom.plans.registry import QUERIES

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"


def plan(spark, df):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize(("name", "scans"), [("exponential_averages", 1), ("serving_contract", 6), ("strongest_levels", 1), ("trend_regime", 1), ("daily_mean_std", 1)])
def test_scans(spark, name, scans):
    """serving_contract reads its features for the tokens, the universe and the reference, and three times for the members (12 before grids were filled without a join)."""
    assert plan(spark, QUERIES[name](spark, SF)).count("FileScan") <= scans


def test_no_frame_is_open_towards_the_future():
    for file in (ROOT / "barloom").rglob("*.py"):
        assert "unboundedFollowing" not in file.read_text(), file


def test_next_event_takes_linear_time(spark):
    def took(n):
        df = spark.range(n).select(F.lit("a").alias("key"), F.timestamp_seconds(F.col("id") * 60).alias("ts"))
        began = time.perf_counter()
        J.next_event(df, F.minute("ts") == 7, key=["key"], ts="ts").write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    took(10_000)
    assert min(took(160_000) for _ in range(2)) < 16 * took(10_000) + 2  # the square would be minutes
