"""Distribution features from states against those from all bars, and ranks of merged sketches against sorted values."""

import numpy as np
from pyspark.sql import functions as F

from barloom.operators import patterns as P
from barloom.operators import sketches as K
from barloom.plans.adapters import shaped

SF = "/root/testdata/sf0.001"
EXACT = ["n", "std_close", "min_close", "max_close", "min_low", "max_volume", "zero_volume_share", "mean_span", "mean_body_share", "wick_share", "green_share", "tiny_move_share", "big_move_share", "turn_share", "max_to_min", "last_ts"]
SKETCHED = ["median_close", "p01_close", "p99_close", "p01_low", "median_volume", "median_body_share", "p05_span", "p95_span"]


def rows(df, columns):
    return {r["key"]: [round(r[c], 8) if isinstance(r[c], float) else r[c] for c in columns] for r in df.collect()}


def test_states_of_parts_give_the_features_of_the_whole(spark):
    """Months that are added later, without reading the earlier bars, and any span of them."""
    bars = shaped(spark, SF).cache()
    cut, since = F.lit("1995-03-01").cast("timestamp"), F.lit("1994-02-01").cast("timestamp")
    old, new = K.period_states(bars.where(F.col("ts") < cut), "month"), K.period_states(bars.where(F.col("ts") >= cut), "month")
    states = old.unionByName(new).cache()
    for options, part in (({}, bars), ({"since": since}, bars.where(F.col("ts") >= since)), ({"since": since, "until": cut}, bars.where((F.col("ts") >= since) & (F.col("ts") < cut)))):
        got, expected = K.distribution_of(states, least_rows=5, **options), P.distribution_features(part, least_rows=5)
        assert rows(got, EXACT) == rows(expected, EXACT) and got.count() > 5


def test_small_sketches_are_exact(spark):
    bars = shaped(spark, SF).cache()
    got = rows(K.distribution_of(K.period_states(bars, "month"), least_rows=5), SKETCHED)
    values = {}
    for r in bars.collect():
        span = r["high"] - r["low"]
        values.setdefault(r["key"], []).append((r["close"], r["low"], r["volume"], None if span == 0 else abs(r["close"] - r["open"]) / span, span))
    for key, found in got.items():
        columns = [sorted(v for v in c if v is not None) for c in zip(*values[key])]
        for value, (column, p) in zip(found, [(0, 0.5), (0, 0.01), (0, 0.99), (1, 0.01), (2, 0.5), (3, 0.5), (4, 0.05), (4, 0.95)]):
            own = columns[column]
            assert (value is None) == (not own) and (not own or value == round(own[max(0, int(np.ceil(p * len(own) - 1e-9)) - 1)], 8))


def test_ranks_of_merged_sketches_are_within_their_error(spark):
    """200,000 values a key in 50 periods: ranks within 1 %."""
    n = 200_000
    bars = spark.range(2 * n).select((F.col("id") % 2).cast("string").alias("key"), F.timestamp_seconds(F.floor(F.col("id") / 2) * 3600 * 24 * 50 / n).alias("ts"), F.pow(F.rand(3), F.lit(3.0)).alias("close"), F.rand(4).alias("volume"))
    bars = bars.select("key", "ts", F.col("close").alias("open"), (F.col("close") + 1).alias("high"), F.col("close").alias("low"), "close", "volume").cache()
    got = K.distribution_of(K.period_states(bars, "day"))
    for r in got.collect():
        closes = np.sort([x["close"] for x in bars.where(F.col("key") == r["key"]).select("close").collect()])
        for value, p in ((r["median_close"], 0.5), (r["p01_close"], 0.01), (r["p99_close"], 0.99)):
            assert abs(np.searchsorted(closes, value, "right") / n - p) < 0.01
        assert r["periods"] == 50 and r["n"] == n
