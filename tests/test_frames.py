"""Frames against Spark's own windows, order statistics against sorted slices, and split series against whole ones."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators import frames as fr
from barloom.operators.frames import Frame, add_frames, running

SCHEMA = "key string, ts timestamp, i int, v double, w double"


def slices(x, valid, n, what, share=0.0):
    """The definition, frame by frame; x of one series."""
    out = []
    for i in range(len(x)):
        rows = range(max(0, i - n + 1), i + 1)
        values = [x[j] for j in rows if valid[j]]
        if what == "count":
            out.append(float(len(values)))
        elif not values:
            out.append(None)
        elif what in ("sum", "mean", "max", "min"):
            out.append(float({"sum": math.fsum, "mean": lambda v: math.fsum(v) / len(v), "max": max, "min": min}[what](values)))
        elif what == "std":
            out.append(None if len(values) < 2 else float(np.std(np.array(values, np.longdouble), ddof=1)))
        elif what == "since_max":
            out.append(float(min(i - j for j in rows if valid[j] and x[j] == max(values))))
        elif what == "kth":
            out.append(sorted(values)[math.floor((len(values) - 1) * share)])
        elif len(values) < n or not valid[i]:
            out.append(None)
        else:
            out.append(sum(v <= x[i] for v in values) / n if what == "share_at_most" else sum(v < x[i] for v in values) / max(1, n - 1))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 7, 16, 50, 400])
def test_kernel_equals_the_definition(n):
    rng = np.random.default_rng(n)
    sizes = [1, 2, 3, 5, 31, 32, 33, 120, 121, 7, 1]
    total = sum(sizes)
    x = np.round(rng.normal(size=total) * 3) + rng.choice([0.0, 1e6], total)  # ties, and two scales
    valid = rng.random(total) < 0.85
    starts = np.cumsum(sizes) - sizes
    wanted = [Frame(what, "x", n, what, 0.1) for what in fr.KINDS]
    found = fr.compute({"x": (np.where(valid, x, 0.0), valid)}, starts, total, wanted)
    for f in wanted:
        expected = [v for a, m in zip(starts, sizes) for v in slices(x[a : a + m], valid[a : a + m], n, f.what, 0.1)]
        values, present = found[f.name]
        assert [bool(p) for p in present] == [v is not None for v in expected], f.what
        assert np.allclose(values[present], [v for v in expected if v is not None], rtol=1e-9, atol=1e-9), f.what


def test_no_cancellation_between_scales():
    """A frame's deviation doesn't suffer from values that have left it, and is exactly 0 where the frame is constant."""
    x = np.concatenate([np.full(50, 1e12), 1e-6 * np.arange(50), np.full(60, 0.1)])
    valid = np.ones(len(x), bool)
    values, _ = fr.compute({"x": (x, valid)}, np.array([0]), len(x), [Frame("std", "x", 10, "std")])["std"]
    assert np.allclose(values[60:100], np.std(1e-6 * np.arange(10), ddof=1), rtol=1e-9)
    assert (values[110:] == 0).all() and (values[9:50] == 0).all()


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    out = []
    for key, m in (("a", 700), ("b", 3), ("c", 90), (None, 40)):
        t = 1_700_000_000
        for i in range(m):
            t += int(rng.integers(0, 9000))  # gaps and ties
            v = None if rng.random() < 0.1 else float(np.round(rng.normal(), 1))
            out.append((key, t, i, v, float(rng.normal())))
    df = spark.createDataFrame(out, "key string, t bigint, i int, v double, w double")
    return df.select("key", F.timestamp_seconds("t").alias("ts"), "i", "v", "w")


def values(df, names):
    return {(r["key"], r["i"]): [None if r[c] is None else round(r[c], 8) + 0.0 for c in names] for r in df.collect()}


@pytest.mark.parametrize("split", [None, 20, 64])
def test_equals_windows(spark, rows, split, monkeypatch):
    monkeypatch.setattr(fr, "LEAST", 50)
    spec = lambda n: Window.partitionBy("key").orderBy("ts", "i").rowsBetween(1 - n, 0)
    native = {"count": F.count, "sum": F.sum, "mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}
    wanted = [Frame(f"{what}_{c}_{n}", c, n, what) for what in native for c in ("v", "w") for n in (1, 5, 60)]
    names = [f.name for f in wanted]
    got = add_frames(rows, wanted, order=["i"], split=split)
    assert got.columns == [*rows.columns, *names]
    expected = rows.withColumns({f.name: native[f.what](f.of).over(spec(f.n)).cast("double") for f in wanted})
    assert values(got, names) == values(expected, names)
    ranks = [Frame("at_most", "w", 30, "share_at_most"), Frame("p10", "v", 30, "kth", 0.1), Frame("since", "w", 30, "since_max")]
    listed = expected.withColumns({"_w": F.collect_list("w").over(spec(30)), "_v": F.array_sort(F.collect_list("v").over(spec(30)))}).select(
        "key", "i", F.when(F.size("_w") >= 30, F.size(F.filter("_w", lambda x: x <= F.col("w"))) / 30).alias("at_most"), F.try_element_at("_v", F.floor((F.size("_v") - 1) * 0.1).cast("int") + 1).alias("p10"),
        (F.array_position(F.reverse("_w"), F.array_max("_w")) - 1).cast("double").alias("since"),
    )
    ranked = [f.name for f in ranks]
    assert values(add_frames(rows, ranks, order=["i"], split=split), ranked) == values(listed, ranked)


def test_running_values_by_chunks(spark, rows):
    past = Window.partitionBy("key").orderBy("ts", "i").rowsBetween(Window.unboundedPreceding, 0)
    got = running(rows, {"total": "v", "n": F.lit(1)}, {"high": "w"}, order=["i"], chunk_seconds=3600)
    expected = rows.withColumns({"total": F.sum("v").over(past), "n": F.count("*").over(past), "high": F.max("w").over(past)})
    assert values(got, ["total", "n", "high"]) == values(expected, ["total", "n", "high"])


def test_empty_tables_and_wrong_frames(spark, rows):
    assert add_frames(rows.limit(0), [Frame("m", "v", 3, "mean")]).collect() == [] and add_frames(rows.limit(0), [Frame("m", "v", 3, "mean")], split=10).collect() == []
    assert add_frames(rows, []) is rows
    with pytest.raises(ValueError):
        Frame("m", "v", 3, "mode")
    with pytest.raises(ValueError):
        Frame("m", "v", 0, "mean")


def test_one_series_is_split_over_tasks(spark):
    one = spark.range(20_000).select(F.lit("all").alias("key"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.sin("id").alias("v"))
    got = add_frames(one, [Frame("m", "v", 500, "mean")], split=1000)
    plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
    alone = [k for k, line in enumerate(plan) if "SinglePartition" in line]
    assert all("HashAggregate" in plan[k + 1] and "_chunk" in plan[k + 1] for k in alone)  # only the totals of chunks, a row each, are scanned in one task
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and sum(sizes) == 20_000


def test_time_does_not_grow_with_the_frame():
    rng = np.random.default_rng(0)
    x, valid = rng.normal(size=200_000), np.ones(200_000, bool)

    def took(n):
        wanted = [Frame(what, "x", n, what) for what in ("mean", "std", "max", "min")]
        began = time.process_time()
        fr.compute({"x": (x, valid)}, np.array([0]), len(x), wanted)
        return time.process_time() - began

    took(48)
    assert min(took(4800) for _ in range(3)) < 1.5 * min(took(48) for _ in range(3)) + 0.05
