"""Ratios over long frames cost no more a row than those over short ones."""

import time

import pytest
from pyspark.sql import functions as F

from barloom.operators import rolling as R


def rows(spark, n):
    return spark.range(n).select(F.lit("a").alias("key"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), (F.col("id") * 7919 % 101 + 1).cast("double").alias("volume"))


def test_activity_ratios_take_time_by_rows_not_by_frames(spark):
    def took(long):
        began = time.perf_counter()
        R.activity_ratios(rows(spark, 30_000), ["volume"], short=(4, 24), long=long, spreads=((4, 24),)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    took(168)
    assert min(took(8000) for _ in range(2)) < 5 * took(168) + 2


def test_activity_ratios_equal_frames_of_spark(spark):
    got = R.activity_ratios(rows(spark, 400), ["volume"]).withColumns({
        "mean": F.avg("volume").over(R.S.rows(24)) / F.avg("volume").over(R.S.rows(168)), "std": F.stddev_samp("volume").over(R.S.rows(24)) / F.stddev_samp("volume").over(R.S.rows(168)), "cum": F.sum("volume").over(R.S.rows(4)) / F.sum("volume").over(R.S.rows(168)),
    }).orderBy("ts").collect()
    for r in got[1:]:
        assert (r.volume_rel_mean_24, r.volume_rel_std_24, r.volume_rel_cum_4) == (pytest.approx(r["mean"]), pytest.approx(r["std"]), pytest.approx(r["cum"]))
