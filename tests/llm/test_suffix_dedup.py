"""Suffix dedup against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest

from barloom.llm import suffix_dedup as sd
from tests.llm.rows import AWKWARD, awkward, empty


def brute(rows, length):
    """{(id, text): removed runs} by the definition; rows are (id, text)."""
    distinct = sorted({((sd.LAST_ID if i is None else i), t or "") for i, t in rows}, key=lambda x: x[0])
    first, out = {}, {}
    for i, text in distinct:
        raw = text.encode()
        gone = [False] * len(raw)
        for k in range(len(raw) - length + 1):
            if first.setdefault(raw[k : k + length], (i, k)) != (i, k):
                gone[k : k + length] = [True] * length
        edges = [k for k in range(len(raw) + 1) if (k < len(raw) and gone[k]) != (k > 0 and gone[k - 1])]
        out[i, text] = list(zip(edges[::2], edges[1::2]))
    return out


def check(spark, rows, length):
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, start string")
    got = sd.suffix_dedup(docs, length=length).collect()
    expected = brute(rows, length)
    want = []
    for i, t in rows:
        raw, spans = (t or "").encode(), expected[sd.LAST_ID if i is None else i, t or ""]
        kept = b"".join(raw[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(raw)]))
        want.append((i, kept, spans))
    assert sorted(((r["doc_id"], bytes(r["kept"]), [tuple(s) for s in r["removed"]]) for r in got), key=str) == sorted(want, key=str)


def prose(rng, n):
    words = ["river", "stone", "light", "née", "über", "a", "the", "of", "windmill", "quiet", "漢字"]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.mark.parametrize("length", [100, 20, 7])
def test_equals_brute_force(spark, length):
    rng = random.Random(length)
    passages = [prose(rng, 30) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 25)) for _ in range(3)]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages)
            cut = sorted(rng.sample(range(len(p)), 2)) if rng.random() < 0.5 else (0, len(p))
            parts.insert(rng.randrange(len(parts)), p[cut[0] : cut[1]])
        rows.append((i, "".join(parts)))
    rows += [(200 + k, rows[k][1]) for k in range(0, 60, 7)]
    rows += [(300, "it " * 200), (301, "it " * 90), (302, "x" * 150), (303, "\x00" * 120 + "y"), (304, "\x00" * 110), (305, passages[0]), (306, passages[0] + passages[0])]
    check(spark, rows, length)


def test_hot_keys_and_small_batches(spark, monkeypatch):
    """Keys with many kinds of pieces go by windows, and levels merge; tasks get the sizes of today's module."""
    rng = random.Random(1)
    phrase = "the committee on weights and measures has found"
    rows = [(i, prose(rng, 6) + " " + phrase + " " + prose(rng, 6)) for i in range(150)]
    rows += [(500 + i, rows[i][1][5:]) for i in range(0, 150, 11)]
    monkeypatch.setattr(sd, "BATCH", 8)
    monkeypatch.setattr(sd, "SCAN", 16)
    check(spark, rows, 60)
    monkeypatch.setattr(sd, "WIDE", 2)
    for length in (60, 50):
        check(spark, rows, length)
    monkeypatch.setattr(sd, "MOST_PIECES", 5)
    check(spark, rows, 60)


def test_long_texts_are_cut_into_stretches(spark, monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(sd, "CHUNK", 300)
    a = prose(rng, 400)
    check(spark, [(1, a), (2, "short"), (3, a[500:1500] + " and more"), (4, a[100:400] + a[100:400])], 50)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in AWKWARD]
    for length in (10, 100):
        if length == 100:
            rows = [(i, t if t is None or len(t) < 1000 else "word " * 400) for i, t in rows]
        docs = [(i, t) for i, t in rows]
        check(spark, docs, length)
    got = {r["doc_id"]: r for r in sd.suffix_dedup(awkward(spark)).collect()}
    assert bytes(got[8]["kept"]) == b"word " and len(got[8]["removed"]) == 1  # all other words are in windows that start earlier
    assert bytes(got[4]["kept"]) == b"" and got[4]["removed"] == []
    assert sd.suffix_dedup(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        sd.suffix_dedup(awkward(spark), length=1)


def test_very_long_text(spark):
    rng = random.Random(4)
    a = "".join(rng.choice("abcdefghij ") for _ in range(300_000))
    got = {r["doc_id"]: r for r in sd.suffix_dedup(spark.createDataFrame([(1, a), (2, "x" + a[1000:200_000]), (3, a[250_000:250_099])], "doc_id bigint, text string")).collect()}
    assert len(got[1]["kept"]) == 300_000 and bytes(got[2]["kept"]) == b"x" and [tuple(s) for s in got[2]["removed"]] == [(1, 199_001)] and len(got[3]["kept"]) == 99


def test_versions_of_one_identifier(spark):
    """Texts of one identifier are documents in some order: one of them stays whole."""
    rng = random.Random(5)
    a = prose(rng, 60)
    got = sd.suffix_dedup(spark.createDataFrame([(1, a), (1, a + " end"), (None, a)], "doc_id bigint, text string")).collect()
    kept = sorted(len(r["kept"]) for r in got)
    n = len(a.encode())
    assert kept in ([0, 0, n + 4], [0, 4, n])


def test_levels_are_few_and_right():
    rng = np.random.default_rng(6)
    index, seen, n = sd.SuffixLevels(9), set(), 0
    for _ in range(60):
        strings = [bytes(rng.integers(97, 99, rng.integers(9, 20), dtype=np.uint8)) for _ in range(5)]
        for s, found in zip(strings, index.add(strings)):
            for k in range(len(s) - 8):
                assert found[k] == (s[k : k + 9] in seen)
                seen.add(s[k : k + 9])
        n = sum(len(order) for _, order in index.levels)
        assert n == len(seen) and len(index.levels) <= 2 + np.log2(n)
        for text, order in index.levels:
            windows = [bytes(text[i : i + 9]) for i in order]
            assert windows == sorted(windows)


def test_digest_of_the_query(spark):
    from barloom.llm import queries

    docs = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in queries.op11_suffix_dedup(spark, "/root/testdata/sf0.001").collect():
        raw, spans = docs[r["doc_id"]], [tuple(map(int, s.split(":"))) for s in r["removed"].split(",") if s]
        kept = b"".join(raw[a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(raw)]))
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
