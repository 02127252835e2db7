import hashlib
import random

from barloom.llm.exact_dedup import PatriciaOwners, exact_dedup
from tests.llm.rows import awkward, empty, lower


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(lower(t), []).append(d)
    out = []
    for d, t in rows:
        ids = [x for x in groups[lower(t)] if x is not None]
        keep = max(ids, default=None)
        out.append((d, keep, len(groups[lower(t)]), d is not None and d == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = exact_dedup(docs, **options)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_awkward_rows_and_empty_table(spark):
    check(awkward(spark))
    check(empty(spark))


def test_hot_group_and_tiny_budget(spark):
    rng = random.Random(1)
    words = ["ab", "abc", "b", "A", "é"]
    rows = [(i, "same text" if i % 3 == 0 else "".join(rng.choices(words, k=rng.randint(0, 4)))) for i in range(3000)]
    check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7), budget_bytes=2000)


def test_texts_of_one_digest_stay_apart(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else "".join(rng.choices("abA", k=rng.randint(1, 6)))) for i in range(900)] + [(None, "hot"), (5, None), (6, "")]
    for n in (0, 1, 2):
        check(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5), digest_bytes=n)


def test_spilled_subtrees_hold_everything():
    rng = random.Random(2)
    texts = ["".join(rng.choices("ab", k=rng.randint(0, 12))).encode() for _ in range(4000)]
    small, large = PatriciaOwners(3000), PatriciaOwners(1 << 30)
    for k, t in enumerate(texts):
        small.insert(t, k, 1, None)
        large.insert(t, k, 1, None)
    expected = {t: [max(k for k, x in enumerate(texts) if x == t), texts.count(t), None] for t in set(texts)}
    assert dict(large.entries()) == expected
    assert dict(small.entries()) == expected


def test_smallest_identifier(spark):
    got = exact_dedup(spark.createDataFrame([(1, "x"), (2, "X")], "doc_id bigint, text string"), keep="smallest")
    assert {(r.doc_id, r.keep_id, r.kept) for r in got.collect()} == {(1, 1, True), (2, 1, False)}
