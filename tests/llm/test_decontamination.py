import random
import re
import tracemalloc

import pandas as pd

from barloom.llm import decontamination
from barloom.llm.common import persisted
from barloom.llm.decontamination import WuManber, contamination
from tests.llm.rows import awkward, empty, lower

BENCH = "item_id bigint, text string, spans string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute(docs, items, size):
    out = []
    windows = [(i, tuple(w[k : k + size])) for i, t in items for w in [words(t)] for k in range(max(1, len(w) - size + 1)) if w]
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for item, p in windows:
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k : k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    found |= {str(item)} if item is not None else set()
        out.append((d, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def check(docs, bench, size=13, **options):
    got = contamination(docs, bench, window=size, **options)
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()], size)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()), key=str) == expected


def test_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = ["a", "b", "É", "c1", "ß"]
    text = lambda n: rng.choice([" ", ", ", "-"]).join(rng.choices(vocabulary, k=n))
    docs = spark.createDataFrame([(i, text(rng.randint(0, 60))) for i in range(300)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i, text(rng.choice([0, 1, 2, 3, 5, 6, 9])), "s") for i in range(30)] + [(None, "c1 c1 c1 a", "s"), (3, None, "s")], BENCH)
    check(docs, bench, 4)
    check(docs, bench, 4, block_bytes=40)  # many passes
    check(docs, bench)


def test_tables_stay_in_bounds_for_a_large_benchmark(spark):
    """50 MB in blocks: tables take at most 10 bytes a byte of a block, while they are built at most twice as much, and all blocks and ends of items are searched."""
    rng = random.Random(8)
    vocabulary = [f"w{rng.randint(0, 10**6)}" for _ in range(50_000)]
    items = [(str(i), " ".join(rng.choices(vocabulary, k=1800)).encode()) for i in range(3500)]
    assert 45e6 < sum(len(t) for _, t in items) < 60e6
    part = items[: len(items) // 10]
    size = sum(len(t) for _, t in part)
    tracemalloc.start()
    built = WuManber(part, 13)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 10 * size and peak < 20 * size
    ends = [(i, f"before {' '.join(t.decode().split()[-13:])} after") for i, t in enumerate(t for _, t in items[::100])]
    assert built.search(ends[0][1].encode().split()) == ([(1, 14)], {"0"})
    docs = spark.createDataFrame([*ends, (99, " ".join(rng.choices(vocabulary, k=5000)))], "doc_id bigint, text string")
    bench = spark.createDataFrame(pd.DataFrame([(i, t.decode()) for i, t in items], columns=["item_id", "text"]))
    got = {r.doc_id: (r.n_hit, list(r["items"])) for r in contamination(docs, bench).collect()}
    assert got == {i: (13, [items[100 * i][0]]) for i in range(len(ends))} | {99: (0, [])}


def test_a_long_item_is_cut_by_whole_windows(spark):
    rng = random.Random(9)
    item = " ".join(str(rng.randint(0, 999)) for _ in range(700))
    words_ = item.split()
    docs = spark.createDataFrame([(k, " ".join(words_[k : k + 13])) for k in range(0, 688)] + [(1000, " ".join(words_[20:32]))], "doc_id bigint, text string")
    got = contamination(docs, spark.createDataFrame([("x", item)], "item_id string, text string"), block_bytes=900).collect()
    assert {r.doc_id for r in got if r.n_hit == 13 and list(r["items"]) == ["x"]} == set(range(688)) and {r.doc_id for r in got if not r.n_hit} == {1000}


def test_awkward_rows_and_empty_tables(spark):
    bench = spark.createDataFrame([(1, "Alpha, beta", "s"), (2, "word " * 14, "s"), (2, "word " * 14, "s")], BENCH)
    check(awkward(spark), bench)
    check(awkward(spark), bench.limit(0))
    check(empty(spark), bench)


def test_passes_write_hits_and_no_texts(spark, monkeypatch):
    """Between the passes of many blocks only hit texts leave a row, one for all copies; the table of all of them goes by digest."""
    written = []
    monkeypatch.setattr(decontamination, "persisted", lambda df: written.append(persisted(df)) or written[-1])
    docs = spark.createDataFrame([(k, "x y z copied") for k in range(500)] + [(1000 + k, f"plain {k}") for k in range(500)] + [(2000, "q r s and x y z"), (2001, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, "x y z"), (2, "q r s"), (3, "never seen here"), (4, "x y z")], "item_id bigint, text string")
    monkeypatch.setattr(decontamination, "superseded", lambda *tables: None)
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in contamination(docs, bench, window=3, block_bytes=6).collect()}
    assert len(got) == 1002 and got[7] == (4, 3, ["1", "4"]) and got[2000] == (7, 6, ["1", "2", "4"]) and got[1003] == (2, 0, []) and got[2001] == (0, 0, [])
    assert len(written) == 4 and all("text" not in t.columns and t.count() <= 2 for t in written)
