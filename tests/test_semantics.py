"""Hand-made frames: nulls, zeros, constants, duplicates, gaps, clock changes and thresholds."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from barloom.functions import expr as X
from barloom.operators import bars as B
from barloom.operators import candles as C
from barloom.operators import cross as K
from barloom.operators import ema as E
from barloom.operators import joins as J
from barloom.operators import labels as L
from barloom.operators import patterns as P
from barloom.operators import quality as Q
from barloom.operators import rolling as R
from barloom.operators import sampling as A
from barloom.operators import sessions as Z
from barloom.operators import trades as T
from barloom.operators import universe as U
from barloom.sources import tables as S

T0 = dt.datetime(2024, 3, 1)
BAR = "key string, ts timestamp, price double, volume double"
OHLC = "key string, ts timestamp, open double, high double, low double, close double, volume double"


def series(spark, prices, key="a", volumes=None, step=1):
    return spark.createDataFrame([(key, T0 + dt.timedelta(hours=step * i), p, None if volumes is None else volumes[i]) for i, p in enumerate(prices)], BAR)


def values(df, column, by="ts"):
    return [r[column] for r in df.orderBy(by).collect()]


def test_guards(spark):
    df = spark.createDataFrame([(1.0, 0.0, None), (None, 2.0, 3.0), (4.0, 2.0, -1.0)], "a double, b double, c double")
    got = df.select(
        X.safe_div("a", "b").alias("div"), X.strict_greatest("a", "b").alias("g"), X.strict_least("a", "b", "c").alias("l"), X.clip("c", -0.5, 2.0).alias("clip"), X.safe_ln("c").alias("ln"), X.zero("a").alias("z"), X.null_if_zero("b").alias("n"),
    ).collect()
    assert [r.div for r in got] == [None, None, 2.0] and [r.g for r in got] == [1.0, None, 4.0] and [r.l for r in got] == [None, None, -1.0]
    assert [r.clip for r in got] == [None, 2.0, -0.5] and [r.z for r in got] == [1.0, 0.0, 4.0] and [r.n for r in got] == [None, 2.0, 2.0] and got[2].ln is None


def test_epochs_nan_and_keys(spark):
    df = spark.createDataFrame([(1.7e9, "x", None), (1.7e12, "y", "z"), (1.7e15, None, "z"), (12.0, "q", "r")], "e double, a string, b string")
    got = df.select(X.normalize_epoch("e").alias("t"), X.text_key("a", "b").alias("k"), X.text_key("a", "b", null_propagates=True).alias("p"), X.surrogate_key("a", "b").alias("s"), X.not_nan(F.lit(float("nan")), 0.0).alias("n")).collect()
    assert len({r.t for r in got[:3]}) == 1 and got[3].t is None
    assert [r.k for r in got] == ["x", "y-z", "z", "q-r"] and [r.p for r in got] == [None, "y-z", None, "q-r"] and len({r.s for r in got}) == 4 and got[0].n == 0.0


def test_correlation_of_constants_is_null(spark):
    df = series(spark, [2.0, 2.0, 2.0], volumes=[1.0, 2.0, 3.0])
    assert df.agg(X.safe_corr("price", "volume").alias("c")).first().c is None
    assert values(df.withColumn("c", X.safe_corr("price", "volume", R.S.rows(3))), "c") == [None] * 3
    assert series(spark, [1.0, 2.0, 4.0], volumes=[1.0, 2.0, 4.0]).agg(X.safe_corr("price", "volume").alias("c")).first().c == pytest.approx(1.0)


def test_grid_fills_gaps_and_keeps_leading_nulls(spark):
    rows = [("a", T0, None, 1.0), ("a", T0 + dt.timedelta(hours=1), 5.0, 2.0), ("a", T0 + dt.timedelta(hours=4), 7.0, None), ("b", T0, 1.0, 1.0)]
    got = B.fill_grid(spark.createDataFrame(rows, BAR)).orderBy("key", "ts").collect()
    assert [(r.price, r.volume) for r in got] == [(None, 1.0), (5.0, 2.0), (5.0, 0.0), (5.0, 0.0), (7.0, 0.0), (1.0, 1.0)]
    assert B.fill_grid(spark.createDataFrame([], BAR)).collect() == []


def test_one_row_keys_and_zero_prices(spark):
    df = R.returns(series(spark, [0.0, 2.0, 0.0, None, 3.0], volumes=[0.0] * 5))
    assert values(df, "ret") == [None, None, -1.0, None, None] and values(df, "logret") == [None] * 5
    one = R.rsi(R.mean_std(R.returns(series(spark, [1.0]))))
    assert values(one, "rsi_14") == [100.0] and values(one, "std_24") == [None]


def test_rows_and_range_frames_differ(spark):
    df = series(spark, [1.0] * 30, volumes=[1.0] * 30)
    w24, h24 = F.count("*").over(R.S.rows(24)), F.count("*").over(R.S.seconds(24 * 3600))
    last = df.select("ts", w24.alias("r"), h24.alias("s")).orderBy(F.desc("ts")).first()
    assert (last.r, last.s) == (24, 25)


def test_features_do_not_look_ahead(spark):
    prices = [100 + 10 * math.sin(i / 3) + (i * 7919 % 13) for i in range(400)]
    df = series(spark, prices, volumes=[float(i % 11 + 1) for i in range(400)])

    def build(d):
        d = R.volume_features(R.cumulative_return(R.extremes(R.realized_vol(R.mean_std(R.returns(d), (24,)), (24,)), (168,))))
        d = R.liquidity(R.breakouts(R.rsi(R.moving_averages(d))))
        return R.vpin(R.jumps(R.dormancy(R.horizons(R.log_gaps(d, 100), (96,), 200))), z=100)

    cut = T0 + dt.timedelta(hours=300)
    whole, part = build(df).where(F.col("ts") <= cut).orderBy("ts").collect(), build(df.where(F.col("ts") <= cut)).orderBy("ts").collect()
    for a, b in zip(whole, part, strict=True):
        for c in a.asDict():
            assert a[c] == b[c] or a[c] == pytest.approx(b[c], rel=1e-9), c


def test_trend_by_running_sums_equals_native_frames(spark):
    prices = [50 + 3 * math.cos(i / 5) + (i * 31 % 17) / 10 for i in range(120)]
    df = R.ols_trend(R.log_price(series(spark, prices)), (48,))
    n = F.row_number().over(R.S.ordered).cast("double")
    df = df.withColumn("n", n)
    w = R.S.rows(48)
    df = df.withColumn("native", X.safe_div(F.covar_pop("log_price", "n").over(w), F.var_pop("n").over(w)))
    for r in df.orderBy("ts").collect()[47:]:
        assert r.trend_slope_48 == pytest.approx(r.native, rel=1e-9)


def test_ema_crosses_blocks_exactly(spark):
    prices = [10 + (i * 37 % 101) / 7 for i in range(700)]
    got = E.ema(series(spark, prices), 21).orderBy("ts").collect()
    num = den = 0.0
    r = 1 - 2 / 22
    for row, p in zip(got, prices):
        num, den = num * r + p, den * r + 1
        assert row.ema_21 == pytest.approx(num / den, rel=1e-12)
    seeded = values(E.ema(series(spark, prices), 200, seed="sma"), "ema_200")
    v = sum(prices[:200]) / 200
    assert seeded[:199] == [None] * 199 and seeded[199] == pytest.approx(v)
    for p, x in zip(prices[200:], seeded[200:]):
        v += (p - v) * 2 / 201
        assert x == pytest.approx(v, rel=1e-12)


def test_sessions_hold_and_local_cut_off_across_clock_change(spark):
    start = dt.datetime(2024, 3, 30, 20)  # Europe/Paris goes to summer time on 2024-03-31
    rows = [("a", start + dt.timedelta(hours=i), 10.0 if i < 2 else 1.0, 1.0) for i in range(24)]
    df = spark.createDataFrame(rows, BAR)
    held = Z.sessionize(df, F.col("price") > 5, 3 * 3600)
    assert sum(values(held, "monitored")) == 5 and set(values(held, "session")) == {1, None}
    local = Z.sessionize_until_local_hour(df, F.col("price") > 5)
    on = [r.ts for r in local.orderBy("ts").collect() if r.monitored]
    assert max(on) == dt.datetime(2024, 3, 31, 4)  # 07:00 in Paris is 05:00 UTC by then


def test_overlapping_extensions_go_to_the_nearest_session(spark):
    flags = [1, 0, 0, 0, 0, 1, 0]
    df = spark.createDataFrame([("a", T0 + dt.timedelta(days=i), float(f), 1.0) for i, f in enumerate(flags)], BAR)
    got = Z.extend_sessions(Z.sessionize(df, F.col("price") == 1, 0), 3, 3).orderBy("ts").collect()
    assert [r.session for r in got] == [1, 1, 1, 2, 2, 2, 2] and [r.in_core for r in got] == [True, False, False, False, False, True, False] and got[3].in_pre and got[6].in_post


def test_first_passage_ties_and_never(spark):
    paths = spark.createDataFrame([("a", T0, h, p) for h, p in enumerate([100.0, 100.0, 121.0, 79.0])] + [("b", T0, h, p) for h, p in enumerate([100.0, 100.0, 100.0, 100.0])], "key string, entry_ts timestamp, h bigint, price double")
    s = L.path_summary(paths, 3, (1, 2, 3), (0.2,), (0.2,))
    got = {r.key: r for r in L.first_passage_label(s, 0.2, 0.2).collect()}
    assert (got["a"].t_up_20, got["a"].t_down_20, got["a"].label, got["a"].peak_h, got["a"].trough_h) == (2, 3, 1, 2, 3)
    assert (got["b"].t_up_20, got["b"].t_down_20, got["b"].label, got["b"].log_r2, got["b"].is_full) == (200, 200, 0, 0.0, 1)


def test_target_and_stop_on_one_bar_is_a_loss(spark):
    bars = spark.createDataFrame([("a", T0 + dt.timedelta(hours=1), 1.0, 2.0, 0.1, 1.0, 1.0)], OHLC)
    entries = spark.createDataFrame([("a", T0, 1.0), ("z", T0, 1.0)], "key string, entry_ts timestamp, entry_price double")
    assert [r.label for r in L.target_before_stop(entries, bars, 0.5, 0.5, 5).collect()] == [0, 0]


def test_level_exits_fill_at_levels(spark):
    rows = [("a", T0 + dt.timedelta(hours=h), c, hi, lo, c, 1.0) for h, (c, hi, lo) in enumerate([(100, 100, 100), (101, 105, 99), (100, 112, 98), (90, 91, 80)])]
    bars = spark.createDataFrame([(k, t, *map(float, x)) for k, t, *x in rows], OHLC)
    (t,) = T.extract_trades(bars, F.col("ts") == F.lit(T0), F.lit(False), stop=0.05, target=0.1, exit_rule="level").collect()
    assert (t.reason, t.exit_price, t.hours, t.worst_low) == ("target", pytest.approx(110.0), 2, 98.0)
    (t,) = T.extract_trades(bars, F.col("ts") == F.lit(T0), F.lit(False), stop=0.05).collect()
    assert (t.reason, t.exit_price) == ("stop", 90.0)


def test_asof_is_strict_or_inclusive_and_null_without_match(spark):
    left = spark.createDataFrame([("a", T0), ("a", T0 + dt.timedelta(hours=2)), ("b", T0)], "key string, ts timestamp")
    right = spark.createDataFrame([("a", T0, 1), ("a", T0 + dt.timedelta(hours=1), 2)], "key string, seen timestamp, v int")
    at = lambda strict: [r.v for r in J.asof_join(left, right, key=["key"], left_ts="ts", right_ts="seen", strict=strict).orderBy("key", "ts").collect()]
    assert at(False) == [1, 2, None] and at(True) == [None, 2, None]


def test_left_interval_join_keeps_lonely_rows(spark):
    left = spark.createDataFrame([("a", T0), ("b", None)], "key string, at timestamp")
    right = spark.createDataFrame([("a", T0 + dt.timedelta(minutes=m), m) for m in (-1, 0, 30, 60, 61)], "key string, ts timestamp, m int")
    got = J.interval_join(left, right, key=["key"], left_ts="at", right_ts="ts", low_seconds=0, high_seconds=3600, how="left", bucket_seconds=600)
    assert sorted(((r.key, r.m) for r in got.collect()), key=str) == [("a", 0), ("a", 30), ("a", 60), ("b", None)]


def test_upsert_in_parts_equals_upsert_at_once(spark):
    schema = "id int, v string, w int"
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], schema)
    parts = [spark.createDataFrame(r, schema) for r in ([(2, "B", 9), (3, "c", 3)], [(4, None, 4)], [(3, "C", 5)])]
    step = target
    for p in parts:
        step = S.upsert(step, p, ["id"], ["v"])
    assert sorted((r.id, r.v, r.w) for r in step.collect() if r.v) == [(1, "a", 1), (2, "B", 2), (3, "C", 3)] and step.count() == 4
    new = S.append_new(target, parts[0].union(parts[0]), ["id"])
    assert [(r.id, r.w) for r in new.collect()] == [(3, 3)]
    assert S.after_global_watermark(target, target.limit(0), "w").count() == 2


def test_protected_tables_are_not_overwritten(spark, tmp_path):
    df = series(spark, [1.0] * 30)
    path = str(tmp_path / "t")
    S.write_partitioned(df, path, cluster=["key"])
    with pytest.raises(PermissionError):
        S.write_partitioned(df, path, mode="overwrite")
    S.write_partitioned(df.where(F.col("ts") >= "2024-03-02").withColumn("price", F.lit(2.0)), path, mode="overwrite", protected=False)
    assert sorted(r.price for r in spark.read.parquet(path).collect()) == [1.0] * 24 + [2.0] * 6
    assert S.evolve(df.schema, df.drop("volume").withColumn("extra", F.lit(1))).columns == ["key", "ts", "price", "volume", "extra"]


def test_seed_scan(spark, tmp_path):
    (tmp_path / "s.csv").write_text("chain,key,tag,notes\nsol,k1,x,why\n")
    assert S.read_seed(spark, str(tmp_path / "s.csv"), S.MANUAL_EXCLUSIONS).collect()[0].notes == "why"


def test_membership_survives_one_low_week_and_leaves_on_the_second(spark):
    d = dt.date(2024, 1, 1)
    rows = [("a", d + dt.timedelta(days=7 * i), low, False, enter) for i, (low, enter) in enumerate([(False, True), (True, False), (False, False), (True, False), (True, False), (False, True)])]
    df = spark.createDataFrame(rows, "key string, week_start date, low_cap boolean, bad_volume boolean, meets_entry boolean")
    got = U.membership_state(df).orderBy("week_start").collect()
    assert [r.member for r in got] == [True, True, True, True, False, True] and [r.exited for r in got][4] and got[5].entered
    seed = spark.createDataFrame([("a", 1, 0, True)], "key string, low_cap_streak int, bad_volume_streak int, member boolean")
    seeded = U.membership_state(df.where("low_cap"), seed).orderBy("week_start").collect()
    assert [r.low_cap_streak for r in seeded] == [2, 3, 4] and not any(r.member for r in seeded)


def test_membership_versions(spark):
    with pytest.raises(ValueError):
        U.membership("v3", None)
    with pytest.raises(ValueError):
        U.membership("v2", None)


def test_undersample_keeps_the_ratio_and_is_stable(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("y"))
    got = A.undersample(df, "y", ["id"])
    counts = {r.y: r["count"] for r in got.groupBy("y").count().collect()}
    assert counts == {1: 715 - (715 - int(0.4 * int(715 / 0.4))), 0: int(0.6 * int(715 / 0.4))}
    assert {r.id for r in got.collect()} == {r.id for r in A.undersample(df.repartition(13), "y", ["id"]).collect()}
    assert A.undersample(df.where("y = 0"), "y", ["id"]).count() == 0


def test_scoring_with_a_fitted_forest(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(200).select((F.col("id") / 10.0).alias("x"), F.when(F.col("id") > 100, 1).otherwise(0).alias("label"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), RandomForestClassifier(numTrees=5, seed=1)]).fit(df)
    got = A.score(df, model, 0.9)
    assert 80 < got.count() <= 100 and got.agg(F.min("p1")).first()[0] >= 0.9
    assert spark.createDataFrame([([],)], "a array<struct<label:int,prob:double>>").select(A.probability_of("a").alias("p")).first().p is None


def test_quality_checks_find_and_pass(spark):
    df = series(spark, [1.0, None, 3.0])
    assert [r.null_columns for r in Q.not_null(df, ["price", "key"]).collect()] == [["price"]]
    assert {r.check_name: r.failing_rows for r in Q.report(df, {"positive": F.col("price") > 0, "large": F.col("price") > 2}).collect()} == {"positive": 0, "large": 1}


def test_manual_and_lasting_exclusions(spark):
    d = dt.date(2024, 1, 1)
    found = spark.createDataFrame([("a", "wash", d), ("a", "wash", d + dt.timedelta(days=91)), ("b", "wash", d), ("b", "wash", d + dt.timedelta(days=90))], "key string, pattern string, window_start date")
    manual = spark.createDataFrame([("c", "bad")], "key string, notes string")
    assert sorted((r.key, r.pattern) for r in P.hardened_exclusions(found, manual).collect()) == [("a", "wash"), ("c", "manual:bad")]


def test_regime_needs_full_windows(spark):
    per_ts = series(spark, [1.0, 2.0, 4.0]).select("ts", F.col("price").alias("x"))
    z = values(K.regime_z(per_ts, "x", 3), "x_z_3")
    assert z[:2] == [None, None] and z[2] == pytest.approx((4 - 7 / 3) / 1.5275252316519468)
    assert values(K.trailing_percentile(per_ts, "x", 3), "x_pct_3") == [None, None, 1.0]


def test_flat_candles(spark):
    bars = spark.createDataFrame([("a", T0 + dt.timedelta(hours=i), 5.0, 5.0, 5.0, 5.0, 0.0) for i in range(40)], OHLC)
    df = C.directional(C.flows(C.spreads(C.bar_moves(C.scalars(bars)))))
    last = df.orderBy(F.desc("ts")).first()
    assert (last.clv, last.body, last.cs_spread_24, last.mfi_24, last.adx_24, last.efficiency_24) == (0.0, 0.0, 0.0, None, None, None)


def test_grid_equals_a_walk_over_hours(spark):
    """Gaps, bars off the steps, repeated bars, nulls and several keys against a walk from the first to the last bar of each key."""
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1, 0, 30)
    rows = [(k, start + dt.timedelta(minutes=60 * h + 17 * (rng.random() < 0.1)), rng.choice([None, float(rng.randint(1, 9))]), rng.choice([None, 2.0])) for k in "abc" for h in sorted(rng.sample(range(1, 90), 30)) + [0]]
    rows += [rows[0], ("a", None, 1.0, 1.0)]
    got = B.fill_grid(spark.createDataFrame(rows, "key string, ts timestamp, price double, volume double"))
    expected = []
    for k in "abc":
        mine = sorted((r for r in rows if r[0] == k and r[1]), key=lambda r: r[1])
        at, price = mine[0][1], None
        while at <= mine[-1][1]:
            here = [r for r in mine if r[1] == at]
            for r in here:
                price = r[2] if r[2] is not None else price
            expected += [(k, at, price, r[3] or 0.0) for r in here] or [(k, at, price, 0.0)]
            at += dt.timedelta(hours=1)
    last = {k: max(r[1] for r in rows if r[0] == k and r[1] and (r[1] - min(x[1] for x in rows if x[0] == k and x[1])) % dt.timedelta(hours=1) == dt.timedelta(0)) for k in "abc"}
    assert sorted(map(tuple, got.collect()), key=str) == sorted((r for r in expected if r[1] <= last[r[0]]), key=str)
