import random
import zlib

from pyspark.sql import functions as F

from barloom.llm.sharding import minimax_cuts, shard_rows
from tests.llm.rows import awkward, empty


def laws(docs, shards=16):
    rows = docs.select("doc_id", "text").collect()
    got = shard_rows(docs, shards=shards).withColumnRenamed("doc_id", "d").collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.d) for r in got)
    text = {r.doc_id: r.text for r in rows}
    shard_of, slots = {}, {}
    for r in got:
        t = (text[r.d] or "").encode()
        assert r.size == len(t) + 1 and r.text_crc32 == zlib.crc32(t) and r.law == "bytes" and r.grown_shard is None
        assert shard_of.setdefault(t, r.shard) == r.shard and 0 <= r.shard < shards
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [0] * shards
    for r in got:
        sizes[r.shard] += r.size
    return sizes


def test_awkward_rows_and_empty_table(spark):
    laws(awkward(spark))
    assert shard_rows(empty(spark)).collect() == []


def test_sizes_are_near_equal_around_a_hot_group(spark):
    rng = random.Random(7)
    even = [(i, "".join(rng.choices("abcdef ", k=rng.randint(50, 400)))) for i in range(4000)]
    sizes = laws(spark.createDataFrame(even, "doc_id bigint, text string"))
    assert max(sizes) < 1.02 * sum(sizes) / 16 and min(sizes) > 0.9 * sum(sizes) / 16
    hot = [(i, "copy " * 50 if i % 3 == 0 else t) for i, t in even]
    sizes = sorted(laws(spark.createDataFrame(hot, "doc_id bigint, text string")))
    assert sizes[-1] > sum(sizes) / 4 and max(sizes[:-1]) < 1.05 * sum(sizes[:-1]) / 15 and sizes[0] > 0.85 * sum(sizes[:-1]) / 15


def smallest_capacity(sizes, shards, alone=()):
    def needs(c):
        used, fill, closed = 0, 0, True
        for k, x in enumerate(sizes):
            if closed or k in alone or fill + x > c:
                used, fill = used + 1, 0
            fill, closed = fill + x, k in alone
        return used

    c = max((x for k, x in enumerate(sizes) if k not in alone), default=0)
    while needs(c) > shards:
        c += 1
    return c


def test_capacity_is_the_smallest_feasible(spark):
    rng = random.Random(8)
    for shards in (1, 3, 7):
        sizes = [rng.randint(1, 30) for _ in range(120)]
        atoms = spark.createDataFrame([(i, s, 1) for i, s in enumerate(sizes)], "position bigint, size bigint, rows bigint")
        got = atoms.join(minimax_cuts(atoms, shards), "position").groupBy("shard").agg(F.sum("size").alias("s"), F.min("position").alias("a"), F.max("position").alias("b"), F.count("*").alias("n")).collect()
        assert all(r.b - r.a + 1 == r.n for r in got) and len(got) <= shards
        assert max(r.s for r in got) == smallest_capacity(sizes, shards)


def test_shards_are_contiguous_around_large_atoms(spark):
    rng = random.Random(9)
    for shards, large in ((16, {40: 4000, 41: 900}), (5, {0: 5000}), (4, {119: 9000, 3: 8000}), (16, {k: 500 + k for k in range(0, 120, 10)})):
        sizes = [large.get(k, rng.randint(1, 30)) for k in range(120)]
        atoms = spark.createDataFrame([(i, s, 1) for i, s in enumerate(sizes)], "position bigint, size bigint, rows bigint")
        shard = {r.position: r.shard for r in minimax_cuts(atoms, shards).collect()}
        assert [shard[k] for k in range(120)] == sorted(shard.values()) and max(shard.values()) < shards and set(shard.values()) == set(range(max(shard.values()) + 1))
        alone, left, n = set(), sum(sizes), shards
        for k in sorted(range(120), key=lambda k: (-sizes[k], k))[: max(1, (shards - 1) // 2)]:
            if not (sizes[k] * n > left and n > 2):
                break
            alone.add(k)
            left, n = left - sizes[k], n - 1
        total = {}
        for k, s in shard.items():
            total[s] = total.get(s, 0) + sizes[k]
        assert all(list(shard.values()).count(shard[k]) == 1 for k in alone)
        assert max(t for s, t in total.items() if s not in {shard[k] for k in alone}) == smallest_capacity(sizes, shards, alone)
