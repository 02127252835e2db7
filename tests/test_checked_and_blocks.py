"""Checks in the pass that writes, and stars of stored blocks without exchanges."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from barloom.operators import universe as U
from barloom.sources import checked as C
from barloom.sources.blocks import ORDERED_SCANS, star_of_blocks, store_block


def rows(spark, *values):
    return spark.createDataFrame(values, "k bigint, v double")


def test_failing_batches_leave_the_table_and_good_ones_publish_once_scanned(spark, tmp_path):
    path = str(tmp_path / "t")
    assert C.published(spark, path) is None
    checks = {"rows": {"null_v": C.null_in("v"), "negative": F.col("v") < 0}, "totals": {"n": (F.count("*"), 1, 10), "sum": (F.sum("v"), None, 100)}}
    scanned = Observation()
    done = C.write_checked(rows(spark, (1, 1.0), (2, 2.0)).observe(scanned, F.count("*").alias("n")), path, **checks, cluster=["k"])
    assert done == {"rows": 2, "null_v": 0, "negative": 0, "n": 2, "sum": 3.0}
    assert scanned.get["n"] == 2  # read once
    for bad, broken in (([(1, None), (2, -1.0), (3, -2.0)], {"null_v": 1, "negative": 2}), ([(1, 200.0)], {"sum": 200.0}), ([(k, 0.0) for k in range(11)], {"n": 11}), ([], {"n": 0, "sum": None})):
        with pytest.raises(C.CheckFailed) as found:
            C.write_checked(rows(spark, *bad), path, **checks)
        assert found.value.found == broken
        assert sorted(tuple(r) for r in C.published(spark, path).collect()) == [(1, 1.0), (2, 2.0)]
    for k in range(3):
        C.write_checked(rows(spark, (k, 5.0)), path, **checks)
        assert C.published(spark, path).collect() == [(k, 5.0)]
    left = sorted(p.name for p in (tmp_path / "t").iterdir())
    assert left == ["v=2", "v=3"]  # two versions, and nothing aside


def test_rules_of_membership_rows(spark):
    inputs = spark.createDataFrame([("a", f"2024-01-{d:02d}", d > 8, False, True) for d in (1, 8, 15, 22, 29)], "key string, week string, low_cap boolean, bad_volume boolean, meets_entry boolean").select("key", F.to_date("week").alias("week_start"), "low_cap", "bad_volume", "meets_entry")
    state = U.membership_state(inputs, rules=U.Rules(cap_weeks=2, volume_weeks=4))
    assert state.where(C.due_to_leave(2, 4)).count() == 0 and state.where("exited").count() == 1
    assert state.withColumn("exited", F.lit(False)).withColumn("member", F.lit(True)).where(C.due_to_leave(2, 4)).count() > 0
    ahead = state.withColumn("used", F.col("week_start").cast("timestamp") - F.expr("interval 1 hour"))
    assert ahead.where(C.looks_ahead("used")).count() == 0 and ahead.withColumn("used", F.col("week_start").cast("timestamp")).where(C.looks_ahead("used")).count() == 5


def test_star_of_fourteen_blocks_has_no_exchange_and_no_sort(spark):
    base = spark.range(4000).select((F.col("id") % 40).alias("key"), F.timestamp_seconds(F.floor(F.col("id") / 40) * 3600).alias("ts"), F.col("id").alias("x"))
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", ORDERED_SCANS)}
    names = [f"block_{k}" for k in range(14)]
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        store_block(base, "star_base", buckets=4)
        for k, name in enumerate(names):
            store_block(base.where(F.col("x") % (k + 2) > 0).select("key", "ts", (F.col("x") * k).alias(f"f{k}")), name, buckets=4)
        out = star_of_blocks(spark, "star_base", names)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 14 and "Exchange" not in plan and "Sort [" not in plan and "BroadcastHashJoin" not in plan
        expected = base
        for k in range(14):
            expected = expected.withColumn(f"f{k}", F.when(F.col("x") % (k + 2) > 0, F.col("x") * k))
        assert sorted(map(tuple, out.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))
        store_block(base.limit(10), "star_base", buckets=4)  # replaced as a whole
        assert spark.table("star_base").count() == 10
    finally:
        for name in ["star_base", *names]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
