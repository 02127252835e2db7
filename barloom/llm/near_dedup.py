"""MinHash near-dedup with odd sketches.

1. Every document becomes the set of 64-bit hashes of its word shingles. Documents with the same set are one class; only one row
   per class goes on, so exact copies cost one narrow row each.
2. A class gets BANDS x ROWS MinHash samples in BANDS bands. Classes that share a band hash are candidates; only their texts are read
   again, for full sets and for odd sketches: bitmaps in which every one of SAMPLES further (sample position, sample value) pairs flips
   one bit. The XOR of two sketches counts the samples in which they differ, which estimates high similarities precisely.
3. A small bucket pairs its members; a larger one pairs each member with the bucket's best-connected member. Pairs whose sketches
   are too far apart go; the rest are confirmed on full sets.
4. Buckets that still span several components afterwards are compared whole, block by block, across components only, so no link is lost
   to the choice of centres. The rows of a block hold full sets, so that what its sketches let through is confirmed right there, nearest first; a
   confirmed link merges two components of the block, and only such links leave the task: fewer than the block has members.
5. Components come from min-label propagation with pointer jumping on link tables; the links of step 4 are between components.

With 5 rows in each of 32 bands, a pair at similarity 0.8 shares no band with probability 3e-6; its estimate has a standard deviation
of 0.0135 and is under LEAST_ESTIMATE with probability 5e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import persisted, superseded

BANDS, ROWS = 32, 5
#: Samples behind an odd sketch, and its size.
SAMPLES = 1024
SKETCH_WORDS = 64
SKETCH_BITS = 64 * SKETCH_WORDS
LEAST_ESTIMATE = 0.74
#: A bucket of at most this many classes pairs its members; a larger one pairs each with its centre.
SMALL_BUCKET = 6
#: Members of one block in the comparison of whole buckets, and hashes in their sets; both on average.
BLOCK, BLOCK_HASHES = 2048, 1 << 21
#: Partners of a member that are confirmed at once, before those that were linked meanwhile are left out.
AT_ONCE = 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_RNG = np.random.default_rng(20240229)
_BYTE_KEY = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
_MULTIPLY = _RNG.integers(1, 1 << 63, BANDS * ROWS + SAMPLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(1, 1 << 63, BANDS * ROWS + SAMPLES, dtype=np.uint64)
#: The first permutations serve the bands, the others the sketch.
FOR_BANDS, FOR_SKETCH = slice(0, BANDS * ROWS), slice(BANDS * ROWS, None)
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def follow(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a sequence that has hash h so far and goes on with word."""
    return mix(h * _BASE + word)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE^0..n-1 and their inverses, modulo 2^64; grown by doubling and kept for the task."""
    have = _POWERS.get("up", np.ones(1, np.uint64))
    back = _POWERS.get("down", np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, have * (have[-1:] * _BASE)])
        back = np.concatenate([back, back * (back[-1:] * _INVERSE)])
    _POWERS["up"], _POWERS["down"] = have, back
    return have[:n], back[:n]


def byte_keys(raw: np.ndarray) -> np.ndarray:
    return _BYTE_KEY[raw]


def word_hashes(keys: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, stop) of every word: the runs of characters where inside holds, of which keys has random values. A hash depends on the word alone."""
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, stops
    up, down = powers(len(keys))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(keys * up)])
    return mix((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(np.uint64)), starts, stops


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of size words; fewer words make one shingle, none make none."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    word, _, _ = word_hashes(byte_keys(raw), ~_SPACE[raw])
    if not len(word):
        return np.zeros(0, np.uint64)
    n = min(size, len(word))
    h = np.full(len(word) - n + 1, n, np.uint64)
    for k in range(n):
        h = follow(h, word[k : len(word) - n + 1 + k])
    return np.unique(h)


def samples(hashes: np.ndarray, which: slice) -> np.ndarray:
    """Smallest values of the set under independent multiply-add hashes (40 bits of them)."""
    multiply, add = _MULTIPLY[which], _ADD[which]
    best = np.full(len(multiply), np.iinfo(np.uint64).max, np.uint64)
    step = max(1, 40_000 // len(multiply))
    for at in range(0, len(hashes), step):
        part = hashes[at : at + step, None] * multiply + add
        np.minimum(best, part.min(0), out=best)
    return best >> np.uint64(24)


def band_hashes(sample: np.ndarray) -> np.ndarray:
    rows = sample.reshape(BANDS, ROWS)
    h = np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS):
        h = follow(h, rows[:, k])
    return h.view(np.int64)


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    """Bit i is the parity of the (position, value) pairs that hash to i; as SKETCH_WORDS signed longs."""
    bit = mix(sample * _BASE + np.arange(len(sample), dtype=np.uint64)) % np.uint64(SKETCH_BITS)
    odd = (np.bincount(bit.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def _differing_bits(estimate: float) -> int:
    """Set bits of the XOR that a similarity of estimate leads to on average."""
    differing = 2 * SAMPLES * (1 - estimate)
    return int(np.ceil(SKETCH_BITS * (1 - (1 - 2 / SKETCH_BITS) ** differing) / 2))


def set_key(h: np.ndarray) -> bytes | None:
    """Identifies a set: two sums of differently mixed hashes and the size; none for an empty one."""
    return h.sum().tobytes() + mix(h + _BASE).sum().tobytes() + len(h).to_bytes(4, "little") if len(h) else None


def _set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            sizes, keys, bands = [], [], []
            for k in range(b.num_rows):
                h = shingle_hashes(texts[k].as_py(), size)
                sizes.append(len(h))
                keys.append(set_key(h))
                bands.append(band_hashes(samples(h, FOR_BANDS)) if len(h) else None)
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "n_shingles": pa.array(sizes, pa.int64()), "key": pa.array(keys, pa.binary()), "bands": pa.array(bands, pa.list_(pa.int64()))})

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            sets, keys, sketches = [], [], []
            for k in range(b.num_rows):
                h = shingle_hashes(texts[k].as_py(), size)
                sets.append(h.view(np.int64))
                keys.append(set_key(h))
                sketches.append(odd_sketch(samples(h, FOR_SKETCH)))
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "key": pa.array(keys, pa.binary()), "hashes": pa.array(sets, pa.list_(pa.int64())), "sketch": pa.array(sketches, pa.list_(pa.int64()))})

    return run


def _near(a: Column, b: Column, most: int) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x) <= most


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) whose sketches are near and whose full sets are similar enough; sets: (id, hashes, sketch, n)."""
    most = _differing_bits(LEAST_ESTIMATE)
    one = lambda side, c: sets.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col(c).alias(f"v{side}"))
    sized = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    near = pairs.distinct().join(one("a", "sketch"), "a").join(one("b", "sketch"), "b").where(sized & _near(F.col("va"), F.col("vb"), most))
    both = persisted(near.select("a", "b")).join(one("b", "hashes"), "b").join(one("a", "hashes"), "a")
    shared = F.size(F.array_intersect("va", "vb"))
    return both.where(100 * shared >= percent * (F.col("na") + F.col("nb") - shared)).select("a", "b").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest identifier reachable over links (a, b), for identifiers that have a link.

    Every round, the label of a vertex and that of its current component root become the smallest label among the vertex's neighbours,
    and then labels jump to the label of their label; the number of rounds grows with the logarithm of the table, also for chains. Each round's
    table is written to the shared folder.
    """
    both = persisted(links.select("a", "b").union(links.select("b", "a")).distinct().toDF("a", "b"))
    labels = persisted(both.select(F.col("a").alias("id")).distinct().withColumn("component", F.col("id")))
    for _ in range(most_rounds):
        # Whether a side is broadcast is left to Spark's own size check.
        heard = both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("near")), "b").groupBy("a").agg(F.min("near").alias("near"))
        heard = labels.join(heard, F.col("id") == F.col("a")).select("id", F.col("component").alias("root"), "near")
        offers = heard.select("id", "near").union(heard.select("root", "near")).groupBy("id").agg(F.min("near").alias("near"))
        step = persisted(labels.join(offers, "id").select("id", F.least("component", "near").alias("next"), F.col("component").alias("old")))
        jump = step.select(F.col("id").alias("next"), F.col("next").alias("beyond"))
        moved = persisted(step.join(jump, "next").select("id", F.least("next", "beyond").alias("component"), "old"))
        superseded(step, labels)
        labels = moved.select("id", "component")
        if moved.where(F.col("component") != F.col("old")).isEmpty():
            superseded(both)
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _links_between(buckets: DataFrame, labels: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components of labels that buckets contain; buckets: (bucket, band, id), members: (id, sketch, bands, hashes).

    A bucket is dealt as pairs of blocks, so a large one spreads over tasks; blocks are bounded in members and in hashes. A pair is confirmed in the
    first band that it shares, and unless links that were found before in the same blocks join its components.
    """
    labelled = buckets.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sized = labelled.join(members.select("id", F.size("hashes").alias("n")).hint("merge"), "id")
    open_ = sized.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"), F.sum("n").alias("size")).where(F.col("low") < F.col("high"))
    open_ = persisted(open_.select("bucket", F.ceil(F.greatest(F.col("members") / BLOCK, F.col("size") / BLOCK_HASHES)).cast("int").alias("blocks")))
    rows = labelled.join(open_, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(members.hint("merge"), "id")
    rows = rows.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "band", "component", "sketch", "bands", "hashes")
    most = _differing_bits(LEAST_ESTIMATE)

    def compare(table: pa.Table) -> pa.Table:
        block, n, band = table.column("block").to_numpy(), table.num_rows, table.column("band")[0].as_py()
        flat = lambda c: table.column(c).combine_chunks().flatten().to_numpy().reshape(n, -1)
        sketch, bands = flat("sketch").view(np.uint64), flat("bands")[:, :band]
        one_block = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        names, component = np.unique(table.column("component").to_numpy(), return_inverse=True)
        first = component.copy()
        size = pc.list_value_length(table.column("hashes")).to_numpy().astype(np.int64)
        stop = size.cumsum()
        start = stop - size
        values, code = np.unique(table.column("hashes").combine_chunks().flatten().to_numpy(), return_inverse=True)
        has = np.zeros(len(values), bool)
        links = []
        for k in range(n):
            rest = k + 1 + np.flatnonzero((component[k + 1 :] != component[k]) & ((block[k + 1 :] != block[k]) | one_block))
            rest = rest[100 * np.minimum(size[rest], size[k]) >= percent * np.maximum(size[rest], size[k])]
            far = np.bitwise_count(sketch[rest] ^ sketch[k]).sum(1)
            rest = rest[np.argsort(far, kind="stable")[: np.count_nonzero(far <= most)]]
            rest = rest[~(bands[rest] == bands[k]).any(1)]
            own = code[start[k] : stop[k]]
            has[own] = True
            while len(rest):
                now, rest = rest[:AT_ONCE], rest[AT_ONCE:]
                shared = np.array([np.count_nonzero(has[code[start[x] : stop[x]]]) for x in now])
                for x in now[100 * shared >= percent * (size[now] + size[k] - shared)]:
                    if component[x] != component[k]:
                        links.append((first[k], first[x]))
                        component[component == component[x]] = component[k]
                rest = rest[component[rest] != component[k]]
            has[own] = False
        a, b = names[np.array(links, np.int64).reshape(-1, 2).T]
        return pa.table({"a": a, "b": b})

    return rows.groupBy("bucket", "i", "j").applyInArrow(compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every row.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Two documents are linked when 100 x shared shingles >=
    percent x all shingles of both, confirmed on full sets; component_id is the smallest identifier reachable over links.
    Null and wordless texts have no shingles and only themselves. Rows with a null identifier take no part: component_id is null
    and kept true. Rows that repeat an identifier are one document that may have several texts: a link of one of them holds for all, and
    each row gets the document's result. An empty table gives an empty result. Other columns are ignored.
    The bands and LEAST_ESTIMATE are made for 80 percent, so that smaller values, which would lose links, are an error.
    """
    if percent < 80:
        raise ValueError("percent is at least 80: bands and sketches would miss links below")
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    signed = persisted(base.mapInArrow(_set_rows(shingle_words), "id bigint, n_shingles bigint, key binary, bands array<bigint>"))
    narrow = signed.select("id", "n_shingles", "key")
    # Equal sets have equal bands; the class goes by its smallest identifier.
    classes = persisted(signed.where(F.col("key").isNotNull() & F.col("id").isNotNull()).groupBy("key").agg(F.min("id").alias("id"), F.first("bands").alias("bands")))
    exploded = classes.select("id", F.posexplode("bands").alias("band", "value"))
    exploded = exploded.select("id", "band", F.xxhash64("band", "value").alias("bucket"))
    # Written first, here and below, so that the join deals both sides anew and can split a bucket that many classes share.
    shared = persisted(exploded.groupBy("bucket").agg(F.count("*").alias("members")).where(F.col("members") > 1))
    buckets = persisted(exploded.join(shared.hint("merge"), "bucket"))
    degree = persisted(buckets.groupBy("id").agg(F.sum("members").alias("degree")))
    # Texts of candidates only. The merge hint makes every size go the same way: the list of candidates grows with the documents.
    texts = base.join(degree.select("id").hint("merge"), "id", "left_semi").withColumn("h", F.xxhash64("text")).groupBy("id", "h").agg(F.first("text").alias("text"))
    sets = persisted(texts.select("id", "text").mapInArrow(_full_sets(shingle_words), "id bigint, key binary, hashes array<bigint>, sketch array<bigint>").withColumn("n", F.size("hashes")))
    ranked = buckets.join(degree.hint("merge"), "id")
    small = ranked.where(F.col("members") <= SMALL_BUCKET).groupBy("bucket").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    within = small.select(F.explode(F.flatten(F.transform("ids", lambda x, i: F.transform(F.slice("ids", i + 2, SMALL_BUCKET), lambda y: F.struct(x.alias("a"), y.alias("b")))))).alias("p")).select("p.a", "p.b")
    large = ranked.where(F.col("members") > SMALL_BUCKET)
    # The best-connected member, by a partial aggregate, so no bucket is gathered.
    centre = persisted(large.groupBy("bucket").agg(F.max(F.struct("degree", (-F.col("id")).alias("less"))).alias("top")).select("bucket", (-F.col("top.less")).alias("centre")))
    star = large.select("bucket", "id").join(centre, "bucket").where(F.col("id") != F.col("centre")).select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
    labels = components(_confirmed(within.union(star), sets, percent))
    members = sets.select("id", "key", "sketch", "hashes").join(classes.select("id", "key", "bands").hint("merge"), ["id", "key"]).drop("key")
    between = persisted(_links_between(large.select("bucket", "band", "id"), labels, members, percent))
    superseded(sets, buckets, shared, degree, centre)
    named = classes.select("key", "id").join(labels, "id", "left").select("key", F.coalesce("component", "id").alias("component"))
    if not between.isEmpty():
        joined = components(between).select(F.col("id").alias("component"), F.col("component").alias("beyond"))
        named = named.join(joined, "component", "left").select("key", F.coalesce("beyond", "component").alias("component"))
    out = narrow.join(named.hint("merge"), "key", "left").withColumn("component", F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", F.when(F.col("id").isNotNull(), F.col("component")).alias("component_id"), (F.coalesce(F.col("id") == F.col("component"), F.lit(True))).alias("kept"))
