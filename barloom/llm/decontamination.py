"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The alphabet is words, and the patterns are the benchmark's windows (13 consecutive words; a shorter item is one
pattern). Patterns of one length share a shift table on the last two words of every alignment, indexed by their hash: a block that occurs in no pattern lets
the search jump over almost a whole window. Where the shift is zero, a bucket by the hash of the suffix block and of the first block of
the window lists the patterns, and a direct comparison of all words confirms an occurrence.

The benchmark is cut into blocks of bounded size by whole windows; a block is broadcast as text, built into tables once a worker, and passed
over all documents. The tables are bytes and sorted numbers that point into the benchmark's text: some 10 bytes a byte of block_bytes, and as much again while they
are built. With several blocks each pass reads the source anew and writes only the spans of texts that are hit, under a digest of the text; the last
pass meets them there. No text is written, and a worker never holds more than one block's tables.
"""

from __future__ import annotations

import uuid
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import persisted, superseded, whole_row

# Word characters are 0-9, a-z (after lower-casing A-Z) and everything beyond ASCII.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """The words of UTF-8 text, lower-cased A-Z."""
    return text.translate(_BYTES).split()


class WuManber:
    """Occurrences of the windows of items (identifier or None, text) of the benchmark."""

    def __init__(self, items: list[tuple[str | None, bytes]], size: int):
        self.names = [name for name, _ in items]
        room: dict[int, int] = {}
        for _, text in items:
            if m := min(size, len(words_of(text))):
                room[m] = room.get(m, 0) + len(text)
        shifts, found, texts, at = {}, {}, [], 0
        for m, held in room.items():
            slots = 1 << max(8, held.bit_length())
            shifts[m] = bytearray(bytes([min(255, m - min(2, m) + 1)]) * slots)
            found[m] = array("q"), array("i"), array("i"), array("i")
        for owner, (_, text) in enumerate(items):
            words = words_of(text)
            m, n = min(size, len(words)), len(words)
            if not m:
                continue
            shift, (keys, starts, stops, owners) = shifts[m], found[m]
            block, mask, start, stop = min(2, m), len(shift) - 1, at, at - 1
            begins = []
            for end in range(1, n + 1):
                begins.append(stop + 1)
                stop += 1 + len(words[end - 1])
                if end >= block:
                    slot = hash(tuple(words[end - block : end])) & mask
                    shift[slot] = min(shift[slot], max(0, m - end))
                if end >= m:
                    first = end - m
                    keys.append(hash((*words[end - block : end], *words[first : first + block])))
                    starts.append(begins[first])
                    stops.append(stop)
                    owners.append(owner)
            texts.append(b" ".join(words))
            at = stop + 1
        self.text = b" ".join(texts)
        self.tables = []
        for m in sorted(found):
            keys, *rest = (np.frombuffer(x, x.typecode) for x in found.pop(m))
            order = np.argsort(keys, kind="stable")
            self.tables.append((m, min(2, m), shifts[m], array("q", keys[order].tobytes()), *(array("i", x[order].tobytes()) for x in rest)))

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(spans of words that lie in an occurrence, merged and in order; items that occur)."""
        n, spans, found = len(words), [], set()
        for m, block, shift, keys, starts, stops, owners in self.tables:
            mask, at = len(shift) - 1, m  # at is the end of the window, exclusive
            while at <= n:
                suffix = words[at - 2 : at] if block == 2 else words[at - 1 : at]
                step = shift[hash((*suffix,)) & mask]
                if step:
                    at += step
                    continue
                key = hash((*suffix, *words[at - m : at - m + block]))
                k = bisect_left(keys, key)
                if k < len(keys) and keys[k] == key:
                    window = b" ".join(words[at - m : at])
                    while k < len(keys) and keys[k] == key:
                        if self.text[starts[k] : stops[k]] == window:
                            spans.append((at - m, at))
                            found.add(self.names[owners[k]])
                        k += 1
                at += 1
        found.discard(None)
        return merged(spans), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            if stop > out[-1][1]:
                out[-1] = (out[-1][0], stop)
        else:
            out.append((start, stop))
    return out


_HITS = pa.struct([("start", pa.int32()), ("stop", pa.int32())])


_BUILT: dict[str, WuManber] = {}


def _built(name: str, items: list[tuple[str | None, bytes]], size: int) -> WuManber:
    """The tables of a block, built once in a worker that serves several tasks; those of an earlier block go."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = WuManber(items, size)
    return _BUILT[name]


def _pass(name: str, block, size: int):
    """Adds one block's spans and items to (text, n_words, spans, items), which come last in each batch; the text goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _built(name, block.value, size).search
        for b in batches:
            counts, spans, items = [], [], []
            text, had_spans, had_items = b.column("text"), b.column("spans"), b.column("items")
            for k in range(b.num_rows):
                words = words_of(text[k].as_py() or b"")
                found, owners = search(words)
                counts.append(len(words))
                before = had_spans[k].as_py()
                spans.append(_as_rows(merged(found + [(s["start"], s["stop"]) for s in before]) if before else found))
                items.append(sorted(owners.union(had_items[k].as_py())))
            columns = {name: b.column(name) for name in b.schema.names if name != "text"} | {"n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, pa.list_(_HITS)), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _as_rows(spans: list[tuple[int, int]]) -> list[dict]:
    return [{"start": x, "stop": y} for x, y in spans]


def _hits(name: str, block, size: int):
    """(digest, spans, items) of the texts (digest, text) that one block hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _built(name, block.value, size).search
        for b in batches:
            text, digest = b.column("text"), b.column("digest")
            found = [(digest[k].as_py(), *search(words_of(text[k].as_py() or b""))) for k in range(b.num_rows)]
            found = [x for x in found if x[1]]
            yield pa.RecordBatch.from_pydict({"digest": pa.array([x[0] for x in found], pa.binary()), "spans": pa.array([_as_rows(x[1]) for x in found], pa.list_(_HITS)), "items": pa.array([sorted(x[2]) for x in found], pa.list_(pa.string()))})

    return run


def _pieces(text: bytes, size: int, most_bytes: int) -> Iterator[bytes]:
    """The text, or if it is longer than most_bytes pieces that share size - 1 words, so that each window lies in one of them."""
    if len(text) <= most_bytes:
        yield text
        return
    words, held = [], 0
    for word in words_of(text):
        words.append(word)
        held += len(word) + 1
        if held > most_bytes and len(words) > 2 * size:
            yield b" ".join(words)
            words = words[1 - size :] if size > 1 else []
            held = sum(map(len, words)) + len(words)
    if len(words) >= size:
        yield b" ".join(words)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, size: int, most_bytes: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark's rows in lists of about most_bytes of text."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).where(F.length("text") > 0)
    part, held = [], 0
    for row in rows.toLocalIterator():
        for text in _pieces(bytes(row.text), size, most_bytes):
            if part and held + len(text) > most_bytes:
                yield part
                part, held = [], 0
            part.append((row.item, text))
            held += len(text)
    if part:
        yield part


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, window: int = 13, block_bytes: int = 16 << 20) -> DataFrame:
    """(id_col, n_words, spans array<struct<start, stop>> of hit words, items array<string>, n_hit) for every row of docs.

    An item of fewer than window words is one pattern; null or wordless texts on either side match nothing. Items with
    a null identifier mark words but are not listed. Repeated rows keep their own result rows. An empty
    benchmark leaves every document clean; an empty docs table gives an empty result. Only the named columns are read.
    """
    found = _searched(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")), benchmark, item_col, item_text_col, window, block_bytes)
    return found.select(F.col("id").alias(id_col), "n_words", "spans", "items", "n_hit")


def _searched(rows: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, window: int, block_bytes: int) -> DataFrame:
    """(id, n_words, spans, items, n_hit) from (id, text as UTF-8 bytes)."""
    spark = rows.sparkSession
    blocks = _blocks(benchmark, item_col, item_text_col, window, block_bytes)
    block, after, earlier = next(blocks, []), next(blocks, None), []
    none = {"spans": F.array().cast("array<struct<start:int,stop:int>>"), "items": F.array().cast("array<string>")}
    if after is not None:
        rows = rows.withColumn("digest", F.unhex(F.sha2("text", 256)))
    while after is not None:
        shared = spark.sparkContext.broadcast(block)
        hits = rows.select("digest", "text").mapInArrow(_hits(uuid.uuid4().hex, shared, window), "digest binary, spans array<struct<start:int,stop:int>>, items array<string>")
        earlier.append(persisted(hits.dropDuplicates(["digest"])))
        shared.destroy()
        block, after = after, next(blocks, None)
    if earlier:
        found = reduce(DataFrame.unionAll, earlier).groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
        found = persisted(found)
        superseded(*earlier)
        rows = rows.join(found, "digest", "left").withColumns({c: F.coalesce(c, none[c]) for c in none})
    state = rows.select("id", "text", F.lit(0).cast("bigint").alias("n_words"), *(list(none) if earlier else [x.alias(c) for c, x in none.items()]))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in state.schema.fields if f.name != "text"])
    state = state.mapInArrow(_pass(uuid.uuid4().hex, spark.sparkContext.broadcast(block), window), schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + (s["stop"] - s["start"]))
    return state.withColumn("n_hit", n_hit)


def is_contaminated(share: int = 20):
    """Column: some word is hit and hit words are at least one in share."""
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, window: int = 13, share: int = 20, block_bytes: int = 16 << 20) -> DataFrame:
    """The rows of docs that aren't contaminated, with all their columns, whatever their names; the hit spans of a row come from the same passes as in contamination().

    Rows with a null, empty or wordless text are clean. Repeated rows have the same fate. An empty benchmark leaves every row; an empty table gives an empty result.
    """
    found = _searched(docs.select(whole_row(docs).alias("id"), F.col(text_col).cast("binary").alias("text")), benchmark, item_col, item_text_col, window, block_bytes)
    return found.where(~is_contaminated(share)).select("id.*")
