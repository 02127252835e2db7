import math
import random

import pytest
import xxhash

from barloom.llm.mixing import mixed, mixture, solve_exponent
from barloom.llm.queries import op4_mixing
from tests.llm.rows import awkward, empty


def weights(shares, a):
    z = sum(p**a for p in shares)
    return [p**a / z for p in shares]


def entropy(w):
    return -sum(x * math.log(x) for x in w)


def bisect(fits, falls):
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if fits(mid) == falls else (low, mid)
    return (low + high) / 2


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(14)
    sources = ["big"] * 20 + ["mid"] * 6 + ["small"] * 2 + [None]
    return spark.createDataFrame([(i, "w " * rng.randint(0, 60), rng.choice(sources)) for i in range(1500)], "doc_id bigint, text string, source string").cache()


def shares_of(docs):
    tokens = {}
    for r in docs.collect():
        tokens[r.source] = tokens.get(r.source, 0) + len(r.text.split())
    return {k: v / sum(tokens.values()) for k, v in tokens.items()}, tokens


def test_exponent_equals_plain_bisection(spark, docs):
    shares, _ = shares_of(docs)
    p = list(shares.values())
    table = spark.createDataFrame([(x,) for x in p], "share double")
    for target in (0.7, 0.9, 0.97):
        a = bisect(lambda a: entropy(weights(p, a)) >= target * math.log(len(p)), True)
        assert solve_exponent(table, least_entropy=target) == pytest.approx(a, abs=1e-9)
    for limit in (1.5, 3.0):
        a = bisect(lambda a: max(w / x for w, x in zip(weights(p, a), p)) <= limit, False)
        assert solve_exponent(table, most_repeats=limit) == pytest.approx(a, abs=1e-9)
    assert solve_exponent(table.limit(0), least_entropy=0.9) == 1.0
    assert solve_exponent(table, least_entropy=0.0) == 1.0


def test_shares_meet_the_weights_and_every_row_is_drawn(docs):
    shares, tokens = shares_of(docs)
    rows = mixture(docs, least_entropy=0.9, most_repeats=None, block_tokens=500).collect()
    assert len(rows) == 1500 and all(r.copies >= 1 for r in rows)
    drawn = {k: sum(r.n_tokens * r.copies for r in rows if r.source == k) for k in shares}
    total = sum(drawn.values())
    for r in rows:
        assert drawn[r.source] / total == pytest.approx(r.weight, abs=60 / total)
    w = [next(r.weight for r in rows if r.source == k) for k in shares]
    assert entropy(w) == pytest.approx(0.9 * math.log(len(w)), abs=1e-6)
    # A source's rest is the start of its permutation.
    for k in shares:
        mine = sorted((r for r in rows if r.source == k and r.n_tokens), key=lambda r: r.position)
        assert [r.position for r in mine] == [sum(x.n_tokens for x in mine[:i]) for i in range(len(mine))]
        copies = [r.copies for r in mine]
        assert copies == sorted(copies, reverse=True) and copies[0] - copies[-1] <= 1


def test_repetition_limit_and_fixed_budget(docs):
    _, tokens = shares_of(docs)
    rows = mixture(docs, least_entropy=0.999, most_repeats=2.0).collect()
    assert max(r.copies for r in rows) <= 2
    budget = sum(tokens.values()) / 2
    rows = mixture(docs, least_entropy=0.9, most_repeats=None, budget_tokens=budget).collect()
    assert sum(r.n_tokens * r.copies for r in rows) == pytest.approx(budget, abs=200)


def spark_hash(*values):
    """Spark's xxhash64 of ints (4 bytes), longs (8 bytes) and strings, chained from seed 42; null changes nothing."""
    h = 42
    for kind, v in values:
        if v is not None:
            h = xxhash.xxh64_intdigest(v.encode() if kind == "string" else v.to_bytes({"int": 4, "long": 8}[kind], "little", signed=True), h)
    return h - (1 << 64 if h >> 63 else 0)


def brute(rows, toward, limit, budget_share, block_tokens, seed=17):
    """{(doc_id, text, source): (weight, block, position, copies)} by plain loops."""
    sized = [(d, t, s, len((t or "").split())) for d, t, s in rows]
    tokens = {}
    for _, _, s, n in sized:
        tokens[s] = tokens.get(s, 0) + n
    total = sum(tokens.values())
    p = [v / total for v in tokens.values() if v]
    a = 1.0
    goal = entropy(p) + toward * (math.log(len(p)) - entropy(p))
    a = bisect(lambda a: entropy(weights(p, a)) >= goal, True)
    a = max(a, bisect(lambda a: max(budget_share * w / x for w, x in zip(weights(p, a), p)) <= limit, False)) if limit else a
    z = sum(x**a for x in p)
    out = {}
    for source, own in tokens.items():
        weight = (own / total) ** a / z if own else 0.0
        due = math.floor(budget_share * total * weight + 0.5)
        passes, rest = divmod(due, own) if own else (1, 0)
        key = "null" if source is None else "=" + source
        blocks = math.ceil(max(own, 1) / block_tokens)
        mine = []
        for d, t, s, n in sized:
            if s == source:
                h = spark_hash(("int", seed), ("long", d), ("string", t))
                mine.append((spark_hash(("int", seed), ("string", key), ("long", h % blocks)), h % blocks, h, d, t, n))
        at = 0
        for _, block, _, d, t, n in sorted(mine, key=lambda x: x[:4]):
            copies = passes + (rest > 0 and n > 0 and 2 * at + n <= 2 * rest)
            out[d, t, source] = (weight, block, at, copies if n else max(copies, 1))
            at += n
    return out


def test_weights_places_and_copies_equal_plain_loops(spark, docs):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    for options in ({"toward_uniform": 0.5, "most_repeats": 4.0, "budget_share": 1.0}, {"toward_uniform": 0.9, "most_repeats": 1.6, "budget_share": 1.0}, {"toward_uniform": 0.3, "most_repeats": None, "budget_share": 2.5}):
        got = mixture(docs, least_entropy=None, block_tokens=400, **options).collect()
        want = brute(rows, options["toward_uniform"], options["most_repeats"], options["budget_share"], 400)
        text = {d: t for d, t, _ in rows}
        assert {(r.doc_id, text[r.doc_id], r.source): (r.block, r.position, r.copies) for r in got} == {k: v[1:] for k, v in want.items()}
        assert all(r.weight == pytest.approx(want[r.doc_id, text[r.doc_id], r.source][0], abs=1e-9) for r in got)
        assert len({r.copies for r in got}) > 1


def test_query_draws_a_budget_at_weights_between_natural_and_uniform(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {d: v for (d, _, _), v in brute(rows, 0.5, 4.0, 1.0, 200_000).items()}
    got = op4_mixing(spark, sf).collect()
    assert {r.doc_id: (r.block, r.position, r.copies) for r in got} == {d: v[1:] for d, v in want.items()}
    total = sum(r.n_tokens for r in got)
    natural = {}
    for r in got:
        natural[r.source] = natural.get(r.source, 0) + r.n_tokens / total
    weight = {r.source: r.weight for r in got}
    assert entropy(list(natural.values())) < entropy(list(weight.values())) < math.log(len(weight)) and {r.copies for r in got} == {0, 1, 2}
    assert sum(r.n_tokens * r.copies for r in got) == pytest.approx(total, rel=0.05)


def test_mixed_rows_of_one_text_in_two_sources_go_by_source(spark):
    rows = [(1, "same words here", "a"), (1, "same words here", "b")] + [(k, f"w{k} x y z", "a") for k in range(2, 40)] + [(99, None, None), (99, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "source as `odd.name`", "doc_id as copies")
    copies = {(r.doc_id, r.source): r.copies for r in mixture(df, most_repeats=None, least_entropy=0.9).collect()}
    assert copies[1, "a"] < copies[1, "b"]
    got = {}
    for r in mixed(df, most_repeats=None, least_entropy=0.9).collect():
        assert r["odd.name"] == r.source and r["copies"] == r.doc_id
        got[r.doc_id, r.source] = got.get((r.doc_id, r.source), 0) + 1
    assert got == {k: v * (2 if k[0] == 99 else 1) for k, v in copies.items() if v}


def test_mixed_rows_keep_their_columns(docs):
    copies = {r.doc_id: r.copies for r in mixture(docs).collect()}
    got = mixed(docs)
    assert got.columns == docs.columns
    seen = {}
    for r in got.collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {k: v for k, v in copies.items() if v}


def test_awkward_rows_and_empty_table(spark):
    assert len(mixture(awkward(spark)).collect()) == 12
    assert all(r.copies >= 1 for r in mixture(awkward(spark)).collect())
    assert mixture(empty(spark)).collect() == [] and mixed(empty(spark)).collect() == []
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id bigint, text string, source string")
    assert [r.copies for r in mixture(blank).collect()] == [1, 1]
