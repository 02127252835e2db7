"""What hangs on the sign of a sum that is 0 but for rounding."""

import datetime as dt

from barloom.operators import cross as K
from barloom.operators import rolling as R

T0 = dt.datetime(2024, 3, 1)
#: Prices whose log returns from one end to the other sum to 0 but for rounding.
ROUND_TRIPS = [(3.1, 7.7, 0.3, 3.1), (0.1, 17.3, 5.9, 0.1), (29.27, 122.79, 2.11, 29.27), (56.25, 0.7, 13.1, 56.25), (9.9, 1.3, 4.7, 9.9), (11.3, 0.9, 77.1, 11.3)]


def features(spark):
    rows = [(f"{k}", T0 + dt.timedelta(hours=i), p, 1.0) for k, prices in enumerate(ROUND_TRIPS) for i, p in enumerate(prices)]
    return R.returns(spark.createDataFrame(rows, "key string, ts timestamp, price double, volume double"))


def test_a_round_trip_has_no_choppiness(spark):
    got = R.persistence(features(spark), (3,)).where("ts = '2024-03-01 03:00:00'").collect()
    assert len(got) == len(ROUND_TRIPS) and all(r.chop_3 is None for r in got)
    assert all(r.chop_3 is not None for r in R.persistence(features(spark), (3,)).where("ts = '2024-03-01 02:00:00'").collect())


def test_a_round_trip_does_not_rise(spark):
    df = R.cumulative_return(features(spark), (3,)).where("ts = '2024-03-01 03:00:00'")
    for c in ("dist_sma_24", "dist_sma_168", "dist_high_168", "rv_24"):
        df = df.withColumn(c, df.cumret_3)
    got = K.universe_stats(df, short="cumret_3", long="cumret_3").first()
    assert got.univ_n == len(ROUND_TRIPS) and (got.univ_share_up, got.univ_share_above_24, got.univ_share_above_168) == (0.0, 0.0, 0.0)
