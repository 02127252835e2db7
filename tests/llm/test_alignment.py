"""Alignment of tokenizers against whole texts that are encoded and aligned byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from barloom.llm import alignment as al
from barloom.llm import queries
from tests.llm.rows import awkward, empty

SF = "/root/testdata/sf0.001"
FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def tokenizers():
    found = al.Tokenizers(open(f"{al.TOKENIZERS}/byte_bpe_50k.json", "rb").read(), open(f"{al.TOKENIZERS}/piece_bpe_32k.model", "rb").read())
    found.whole = Tokenizer.from_file(f"{al.TOKENIZERS}/byte_bpe_50k.json")
    found.whole.encode_special_tokens = True
    return found


def encoded(tokenizers, text):
    """(A's tokens, B's tokens) of the whole text as (id, bytes), or None."""
    if not text:
        return None
    a = [(k, tokenizers.a_bytes[k]) for k in tokenizers.whole.encode(" " + text, add_special_tokens=False).ids]
    b = [(k, tokenizers.b_bytes[k]) for k in tokenizers.b.encode(text)]
    same = b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode()
    return (a, b) if same else None


def brute(tokenizers, texts):
    """The contract's figures of every text, by intervals of bytes."""
    links, groups, sizes, held = [], [], [], defaultdict(set)
    for n, text in enumerate(texts):
        found = encoded(tokenizers, text)
        links.append([])
        groups.append("")
        sizes.append((0, 0))
        if found is None:
            continue
        spans = []
        for tokens in found:
            ends = np.cumsum([len(x) for _, x in tokens])
            spans.append([(k, int(e) - len(x), int(e)) for (k, x), e in zip(tokens, ends)])
        a, b = spans
        sizes[-1] = (len(a), len(b))
        both = {e for *_, e in a} & {e for *_, e in b}
        start, out = 0, []
        for end in sorted(both):
            out.append("|".join(",".join(str(k) for k, s, e in side if start <= s and e <= end) for side in (a, b)))
            start = end
        groups[-1] = ";".join(out)
        j = 0
        for k, s, e in a:
            while b[j][2] <= s:
                j += 1
            m = j
            while m < len(b) and b[m][1] < e:
                links[-1].append((k, b[m][0]))
                m += 1
        for pair in set(links[-1]):
            held[pair].add(n)
    counts = {p: len(x) for p, x in held.items()}
    top = Counter()
    for (k, _), c in counts.items():
        top[k] = max(top[k], c)
    return [
        (*sizes[n], len(groups[n].split(";")) if groups[n] else 0, len(links[n]), sum(counts[p] == top[p[0]] for p in links[n]), sum(counts[p] for p in links[n]), hashlib.sha256(groups[n].encode()).hexdigest() if groups[n] else "")
        for n in range(len(texts))
    ]


TEXTS = [
    "Plain words, here and there.", "two  spaces\n\nand breaks\n", " leading", "trailing ", "\nfirst", "a\tb\r\nc", "été ÉTÉ \U0001f600 x", "<s> <0x0A> <|endoftext|> </s>", "it's we'll I'd 123 4567 ...!!", "▁piece", " ",
    "", None, "nbsp here  em", "漢字 かな 한국어", "x" * 3000, "a ́combining", "é \x1c \x85 end", "word\n word \n word", "Tab\t tab \n\n  end  ",
]


def test_parts_are_encoded_as_the_whole(tokenizers):
    assert tokenizers.apart
    for text in filter(None, TEXTS):
        parts = [al.part_text(p) for p in tokenizers.parts(text)]
        assert "".join(parts) == " " + text
        whole, found = encoded(tokenizers, text), [encoded(tokenizers, p[1:]) if p[0] == " " else None for p in parts]
        if whole and None not in found:  # parts that start with a line break can't be encoded alone
            for side in (0, 1):
                assert [k for ids in found for k in ids[side]] == whole[side]


def test_ranks_give_the_ids_of_the_vocabulary(tokenizers):
    """On all vocabulary entries in random company, and on random characters."""
    rng = random.Random(3)
    entries = [t for t in (x.decode(errors="ignore").strip() for x in tokenizers.a_bytes) if t]
    odd = "abcdefABCDEF0123456789+/=.,;:!?'\"-_#é漢한́\U0001f600ﬁ\u200b\xa0 \t\r\n"
    texts = [" " + "".join(rng.choice(entries) for _ in range(rng.randint(1, 6))) for _ in range(20_000)] + [" " + "".join(rng.choice(odd) for _ in range(rng.randint(1, 40))) for _ in range(20_000)]
    assert tokenizers.ranks is not None
    assert tokenizers.encode(texts)[0] == [e.ids for e in tokenizers.whole.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("most_pairs", [1 << 22, 150])
def test_equals_brute_force(spark, tokenizers, most_pairs):
    """In one slice, and in many with a join."""
    texts = [*TEXTS, "Plain words, here and there.", "here and there", TEXTS[6]]
    docs = spark.createDataFrame([(k % 20, t, k) for k, t in enumerate(texts)] + [(None, "here", 1)], "doc_id bigint, text string, n_a bigint")
    got = al.alignment(docs, most_pairs=most_pairs).collect()
    expected = brute(tokenizers, [*texts, "here"])
    assert sorted(([r["doc_id"], *(r[c] for c in FIGURES)] for r in got), key=str) == sorted(([i, *e] for i, e in zip([*(k % 20 for k in range(len(texts))), None], expected)), key=str)


def test_query_equals_brute_force(spark, tokenizers):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = brute(tokenizers, [r["text"] for r in rows])
    got = queries.op12_alignment(spark, SF).collect()
    assert sorted((r["doc_id"], *(r[c] for c in FIGURES)) for r in got) == sorted((r["doc_id"], *e) for r, e in zip(rows, expected))


@pytest.mark.parametrize("most_pairs", [1 << 22, 40])
def test_awkward_rows(spark, tokenizers, most_pairs):
    docs = awkward(spark)
    rows = docs.collect()
    got = al.alignment(docs, most_pairs=most_pairs).collect()
    expected = brute(tokenizers, [r["text"] for r in rows])
    assert sorted(str((r["doc_id"], *(r[c] for c in FIGURES))) for r in got) == sorted(str((r["doc_id"], *e)) for r, e in zip(rows, expected))
    assert al.alignment(empty(spark), most_pairs=most_pairs).count() == 0


def test_minimal_hash_is_minimal_and_verified():
    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(0, 1 << 47, 50_000))
    blocks = 7
    rows = []
    for block in range(1, blocks):  # block 0 isn't here
        own = pairs[al.spread(pairs) % blocks == block]
        sizes, bits, ordered = al.minimal_hash(own)
        rows.append((block, sizes, np.packbits(bits).tobytes(), ordered))
    table = al.PairTable(blocks, rows)
    here = al.spread(pairs) % blocks > 0
    index = table.find(pairs)
    assert (index[~here] == -1).all() and np.array_equal(np.sort(index[here]), np.arange(here.sum())) and np.array_equal(table.pairs[index[here]], pairs[here])
    strangers = np.setdiff1d(rng.integers(0, 1 << 47, 50_000), pairs)
    assert (table.find(strangers) == -1).all()
    assert (al.PairTable(1, []).find(pairs) == -1).all()


def test_tasks_may_forget_what_they_know(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(al, "MOST_PARTS", 5)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60)
    rows = docs.collect()
    small = spark.createDataFrame(rows, docs.schema)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = al.alignment(small).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r["doc_id"], *(r[c] for c in FIGURES)) for r in got) == sorted((r["doc_id"], *e) for r, e in zip(rows, brute(tokenizers, [r["text"] for r in rows])))
