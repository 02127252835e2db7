"""Substring dedup with a logarithmic family of suffix arrays, dealt by anchors.

A window is a string of length bytes. Each byte of a window that also starts earlier (in a document that comes before, or before in the same one) is removed.

1. The anchor of a window is the leftmost of its ANCHOR-byte strings with the least hash. Equal windows have equal anchors, so all that can match has the same key.
   Neighbouring windows with one anchor form a piece; pieces, of at most 2 length bytes, are what goes around. Tasks count keys; only pieces of keys that occur again go on.
2. Pieces with equal bytes (128 bits of hashes) are merged: the earliest stays, all windows of the others are repeats. Keys with one kind of piece are settled by that.
3. Pieces that differ but share a key are cut from their texts and dealt by key, in document order. A task takes them in batches. Each batch gets a suffix array,
   which is merge-scanned against the levels of its index: sorted arrays of the distinct windows so far. What isn't found becomes a new level, and levels of about equal size
   merge, so there are logarithmically many. Windows are compared byte by byte.
   Many pieces of one key are dealt in two parts first: windows that hold what follows the anchor, by anchor and that, and the others, which hold what stands before it, by both.
4. A key with very many different pieces is cut to single windows, which are grouped by hash like the pieces of step 2.

Documents are ordered by identifier; texts of one identifier that differ are documents of their own, in the order of a hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import join_counted, persisted, superseded
from barloom.llm.near_dedup import byte_keys, mix, powers

#: Bytes of texts that are hashed at once; a longer text is cut into stretches whose windows overlap in nothing but bytes. Places take 24 bits.
CHUNK, PLACE = 1 << 20, np.uint64((1 << 24) - 1)
#: Pieces of a key with more different ones than WIDE are dealt by what stands beside the anchor, too; those of a key with more than MOST_PIECES are cut to windows.
WIDE, MOST_PIECES = 64, 1 << 14
#: Pieces of one batch, and of one task on average.
BATCH, PER_TASK = 1 << 13, 1 << 16
#: Windows that are compared at once in a merge scan.
SCAN = 1 << 15
#: Comes after every identifier.
LAST_ID = (1 << 63) - 1


@dataclass
class Pieces:
    """By piece: the text, its first window, the number of windows, hash of the anchor, hash of the bytes, and whether its text has had the same piece before."""

    doc: np.ndarray
    start: np.ndarray
    n: np.ndarray
    key: np.ndarray
    content: np.ndarray
    again: np.ndarray


def _anchor(length: int) -> int:
    return max(1, length // 3)


def _stretch(raw: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(doc, place, windows, key, content) of the pieces of texts that stand in raw and stop at ends."""
    size = _anchor(length)
    n = len(raw) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    up, down = powers(len(raw))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte_keys(raw) * up)])
    hashes = mix((total[size:] - total[: len(raw) - size + 1]) * down[: len(raw) - size + 1])
    # The least hash of each window, its place in the lowest bits.
    least, span, wanted = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64), 1, length - size + 1
    while 2 * span <= wanted:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[wanted - span : wanted - span + n])
    anchor = (least & PLACE).astype(np.int64)
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))[:n]
    whole = np.arange(n) + length <= ends[doc]
    edge = np.ones(n, bool)
    edge[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (whole[1:] != whole[:-1])
    first = np.flatnonzero(edge)
    windows = np.diff(first, append=n)
    first, windows = first[whole[first]], windows[whole[first]]
    stop = first + windows + length - 1
    content = mix((total[stop] - total[first]) * down[first] + mix(windows.astype(np.uint64) + np.uint64(1)))
    return doc[first], first, windows, hashes[anchor[first]], content


def pieces(texts: list[bytes], length: int) -> Pieces:
    """The pieces of some texts, in order."""
    found: list[tuple[np.ndarray, ...]] = []
    part: list[int] = []
    held = 0

    def close() -> None:
        raw = np.frombuffer(b"".join([texts[k] for k in part]), np.uint8)
        sizes = np.array([len(texts[k]) for k in part])
        doc, place, *rest = _stretch(raw, np.cumsum(sizes), length)
        found.append((np.array(part)[doc], place - (np.cumsum(sizes) - sizes)[doc], *rest))

    for k, text in enumerate(texts):
        if len(text) > CHUNK:
            raw = np.frombuffer(text, np.uint8)
            for at in range(0, len(text) - length + 1, CHUNK):
                own = raw[at : at + CHUNK + length - 1]
                doc, place, *rest = _stretch(own, np.array([len(own)]), length)
                found.append((doc + k, place + at, *rest))
            continue
        if len(text) < length:
            continue
        if held + len(text) > CHUNK:
            close()
            part, held = [], 0
        part.append(k)
        held += len(text)
    if part:
        close()
    if not found:
        found = [_stretch(np.zeros(0, np.uint8), np.zeros(0, np.int64), length)]
    doc, start, n, key, content = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(doc, kind="stable")  # long texts may stand before the others
    doc, start, n, key, content = (x[order] for x in (doc, start, n, key, content))
    again = np.ones(len(doc), bool)
    again[np.unique(mix(key + mix(content + mix(doc.astype(np.uint64)))), return_index=True)[1]] = False
    return Pieces(doc, start, n, key.view(np.int64), content.view(np.int64), again)


def _key_counts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pieces(b.column("raw").to_pylist(), length)
            key, n = np.unique(x.key[~x.again], return_counts=True)
            yield pa.RecordBatch.from_pydict({"key": pa.array(key), "n": pa.array(n)})

    return run


_PIECES = "key bigint, content bigint, id bigint, version int, start int, n int"


def _piece_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pieces(b.column("raw").to_pylist(), length)
            rows = np.flatnonzero(~x.again)
            for k in range(0, len(rows), 50_000):
                own = rows[k : k + 50_000]
                take = pa.array(x.doc[own])
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(x.key[own]), "content": pa.array(x.content[own]), "id": b.column("id").take(take), "version": b.column("version").take(take),
                    "start": pa.array(x.start[own].astype(np.int32)), "n": pa.array(x.n[own].astype(np.int32)),
                })

    return run


_STRINGS = "key bigint, content bigint, id bigint, version int, start int, n int, string binary"


def _beside(text: bytes, start: int, n: int, key: int, length: int) -> list[tuple[int, int, int]]:
    """(key, start, windows) of the two parts of a piece: windows that hold the size bytes behind the anchor, and those that hold as many before it. size is a third of length at most."""
    size = _anchor(length)
    raw = np.frombuffer(text, np.uint8)[start : start + n + length - 1]
    up, down = powers(len(raw))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte_keys(raw) * up)])
    hash_of = lambda i, k: mix((total[i + k] - total[i]) * down[i])
    anchor = int(np.argmax(hash_of(np.arange(len(raw) - size + 1), size).view(np.int64) == key))
    first = min(max(anchor - (length - 2 * size), 0), n)  # from here on windows reach over what follows
    out = []
    if first < n:
        out.append((hash_of(np.array([anchor]), 2 * size), first, n - first))
    if first > 0:
        out.append((mix(hash_of(np.array([anchor - size]), 2 * size)), 0, first))
    return [(int(h.view(np.int64)[0]), start + at, windows) for h, at, windows in out]


def _strings(length: int):
    """The bytes of the wanted pieces, wide ones in two parts; of hot ones, the hash of every window in place of its bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                text, wanted = b.column("raw")[row].as_py(), b.column("wanted")[row].values
                start, n, key, hot, wide = (wanted.field(c).to_numpy(zero_copy_only=False) for c in ("start", "n", "key", "hot", "wide"))
                if (wide & ~hot).any():
                    parts = [p for k in np.flatnonzero(wide & ~hot).tolist() for p in _beside(text, int(start[k]), int(n[k]), int(key[k]), length)]
                    rest = hot | ~wide
                    key, start, n = (np.concatenate([x[rest], np.array(y, x.dtype)]) for x, y in zip((key, start, n), zip(*parts)))
                    hot = np.concatenate([hot[rest], np.zeros(len(parts), bool)])
                raw, cold = np.frombuffer(text, np.uint8), np.flatnonzero(~hot)
                strings = [text[i : i + k + length - 1] for i, k in zip(start[cold].tolist(), n[cold].tolist())]
                content = np.zeros(len(cold), np.int64)
                if hot.any():
                    up, down = powers(len(raw))
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(byte_keys(raw) * up)])
                    own = np.flatnonzero(hot)
                    at = np.repeat(start[own] - np.cumsum(n[own]) + n[own], n[own]) + np.arange(n[own].sum())
                    content = np.concatenate([content, mix((total[at + length] - total[at]) * down[at]).view(np.int64)])
                    key, start, n = (np.concatenate([x[cold], y]) for x, y in ((key, np.repeat(key[own], n[own])), (start, at), (n, np.ones(len(at), n.dtype))))
                    strings += [None] * len(at)
                else:
                    key, start, n = key[cold], start[cold], n[cold]
                for k in range(0, len(key), 20_000):
                    part = slice(k, k + 20_000)
                    same = np.zeros(len(key[part]), np.int64) + row
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array(key[part]), "content": pa.array(content[part]), "id": b.column("id").take(pa.array(same)), "version": b.column("version").take(pa.array(same)),
                        "start": pa.array(start[part].astype(np.int32)), "n": pa.array(n[part].astype(np.int32)), "string": pa.array(strings[part], pa.binary()),
                    })

    return run


class SuffixLevels:
    """Suffix arrays of all windows so far, cut to length bytes, in levels of geometrically falling sizes; each is (bytes, sorted starts of distinct windows)."""

    def __init__(self, length: int):
        self.length, self.levels = length, []

    def _windows(self, text: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """As strings of equal length: that trailing zero bytes don't count in comparisons doesn't matter then."""
        return np.lib.stride_tricks.sliding_window_view(text, self.length)[starts].view(f"S{self.length}").ravel()

    def _blocks(self, level: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        for k in range(0, len(level[1]), SCAN):
            yield k, self._windows(level[0], level[1][k : k + SCAN])

    def _found(self, level: tuple[np.ndarray, np.ndarray], sought: np.ndarray) -> np.ndarray:
        """Which of the sorted windows sought are in the level: a merge scan."""
        out = np.zeros(len(sought), bool)
        for _, own in self._blocks(level):
            i, j = np.searchsorted(sought, own[0], "left"), np.searchsorted(sought, own[-1], "right")
            at = np.searchsorted(own, sought[i:j])
            out[i:j] = own[at] == sought[i:j]
        return out

    def _merged(self, one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """One level of two without common windows."""
        at = np.full(len(other[1]), len(one[1]), np.int64)
        new = self._windows(*other)
        low = 0
        for k, own in self._blocks(one):
            high = np.searchsorted(new, own[-1])
            at[low:high] = k + np.searchsorted(own, new[low:high])
            low = high
        return np.concatenate([one[0], other[0]]), np.insert(one[1], at, other[1] + len(one[0]))

    def add(self, strings: list[bytes]) -> list[np.ndarray]:
        """By string and window: it starts earlier in the strings so far. The strings become part of the index."""
        text = np.frombuffer(b"".join(strings), np.uint8)
        sizes = np.array([len(s) for s in strings])
        n = sizes - self.length + 1
        first = np.cumsum(sizes) - sizes
        starts = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        windows = self._windows(text, starts)
        order = np.argsort(windows, kind="stable")
        windows = windows[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = windows[1:] != windows[:-1]
        known = np.zeros(int(fresh.sum()), bool)
        for level in self.levels:
            known |= self._found(level, windows[fresh])
        again = np.empty(len(order), bool)
        again[order] = ~fresh | known[np.cumsum(fresh) - 1]
        if not known.all():
            self.levels.append((text, starts[order[fresh]][~known]))
        while len(self.levels) > 1 and len(self.levels[-2][1]) <= 2 * len(self.levels[-1][1]):
            self.levels[-2:] = [self._merged(*self.levels[-2:])]
        return np.split(again, np.cumsum(n)[:-1])


_REPEATS = "id bigint, version int, start int, n int"


def _scan(length: int):
    """(id, version, start, n): runs of windows that start earlier, of pieces that come in document order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = SuffixLevels(length)
        for whole in batches:
            for k in range(0, whole.num_rows, BATCH):
                b = whole.slice(k, BATCH)
                found = index.add(b.column("string").to_pylist())
                flat = np.concatenate([np.concatenate([x, [False]]) for x in found])  # a run ends with its piece
                edge = np.diff(flat.astype(np.int8), prepend=np.int8(0))
                low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                sizes = np.array([len(x) + 1 for x in found])
                ends = np.cumsum(sizes)
                piece = np.searchsorted(ends, low, "right")
                take = pa.array(piece)
                start = b.column("start").to_numpy()[piece] + low - (ends - sizes)[piece]
                yield pa.RecordBatch.from_pydict({"id": b.column("id").take(take), "version": b.column("version").take(take), "start": pa.array(start.astype(np.int32)), "n": pa.array((high - low).astype(np.int32))})

    return run


def _place(x: DataFrame | None = None) -> Column:
    of = (lambda c: x[c]) if x is not None else F.col
    return F.struct(of("id").alias("id"), of("version").alias("version"), of("start").alias("start"))


def _later(rows: DataFrame) -> DataFrame:
    """(id, version, start, n) of all rows of a (key, content) but the earliest."""
    firsts = persisted(rows.groupBy("key", "content").agg(F.min(_place()).alias("first"), F.count("*").alias("n")).where(F.col("n") > 1).withColumnsRenamed({"key": "k", "content": "c"}))
    total = firsts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    met = join_counted(rows.withColumnRenamed("n", "windows"), firsts, lambda x: (F.col("key") == x["k"]) & (F.col("content") == x["c"]), total)
    out = persisted(met.where(_place() != F.col("first")).select("id", "version", "start", F.col("windows").alias("n")))
    superseded(firsts)
    return out


def _ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID)).alias("id"), F.hash(text).alias("version"), text.cast("binary").alias("raw"))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 100) -> DataFrame:
    """(id, version, start, n): the n windows of a text from start on, in bytes, also start earlier; without those of pieces that the text itself repeats.

    id is LAST_ID for a null identifier; version is the hash of the text.
    """
    base = _ordered(docs, id_col, text_col).where(F.length("raw") >= length).drop("doc_id")
    counts = base.select("raw").mapInArrow(_key_counts(length), "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > 1)
    counts = persisted(counts.withColumnRenamed("key", "k"))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = base.mapInArrow(_piece_rows(length), _PIECES).withColumnRenamed("n", "windows")
    rows = persisted(join_counted(rows, counts, lambda x: F.col("key") == x["k"], total).drop("k").withColumnRenamed("windows", "n"))
    superseded(counts)
    copies = _later(rows)
    # Keys with several kinds of pieces; the earliest of each kind goes to the suffix arrays.
    kinds = persisted(rows.groupBy("key", "content").agg(F.min(F.struct("id", "version", "start", "n")).alias("at")).select("key", "at.*"))
    mixed = persisted(kinds.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > 1).select(F.col("key").alias("k"), "n", (F.col("n") > MOST_PIECES).alias("hot"), (F.col("n") > WIDE).alias("wide")))
    total = mixed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    wanted = join_counted(kinds.withColumnRenamed("n", "windows"), mixed, lambda x: F.col("key") == x["k"], total)
    wanted = persisted(wanted.groupBy("id", "version").agg(F.collect_list(F.struct("start", F.col("windows").alias("n"), "key", "hot", "wide")).alias("wanted")))
    superseded(rows, kinds, mixed)
    texts = base.hint("merge").join(wanted.withColumnsRenamed({"id": "i", "version": "v"}), (F.col("id") == F.col("i")) & (F.col("version") == F.col("v")))
    strings = persisted(texts.select("id", "version", "raw", "wanted").mapInArrow(_strings(length), _STRINGS).dropDuplicates(["id", "version", "start"]))
    superseded(wanted)
    cold = strings.where(F.col("string").isNotNull())
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PER_TASK)
    scanned = persisted(cold.repartition(tasks, "key").sortWithinPartitions("id", "version", "start").select("id", "version", "start", "string").mapInArrow(_scan(length), _REPEATS))
    hot = _later(strings.where(F.col("string").isNull()).drop("string"))
    superseded(strings)
    return copies.unionByName(scanned).unionByName(hot)


_OUT = "id bigint, kept binary, removed array<struct<start:int,stop:int>>"


def _cut(length: int):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, known = b.column("raw").to_pylist(), b.column("repeats")
            own = pieces(texts, length)
            low = np.searchsorted(own.doc, np.arange(len(texts) + 1))
            kept, removed = [], []
            for k, text in enumerate(texts):
                part = slice(low[k], low[k + 1])
                again = own.again[part]
                start, n = own.start[part][again], own.n[part][again]
                if known[k].is_valid:
                    more = known[k].values
                    start, n = np.concatenate([start, more.field("start").to_numpy()]), np.concatenate([n, more.field("n").to_numpy()])
                if not len(start):
                    kept.append(text)
                    removed.append([])
                    continue
                cover = np.zeros(len(text) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + n + length - 1, -1)
                gone = np.cumsum(cover) > 0
                edge = np.diff(gone.astype(np.int8), prepend=np.int8(0))
                kept.append(np.frombuffer(text, np.uint8)[~gone[:-1]].tobytes())
                removed.append([{"start": i, "stop": j} for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())])
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "kept": pa.array(kept, pa.binary()), "removed": pa.array(removed, kind)})

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 100) -> DataFrame:
    """(id_col, kept binary, removed array<struct<start, stop>>) for every row: the bytes that stay and the maximal runs that don't, as offsets in UTF-8 bytes, stop exclusive.

    A byte goes if some string of length bytes that covers it starts earlier as well: in a document with a smaller identifier, or before in the same one. Strings are
    judged on the input. A null text is empty; texts of fewer than length bytes lose nothing. Null identifiers come last, as one identifier. Rows that repeat an identifier and text are one
    document and get the same result; an identifier with several texts is several documents, in the order of a hash of 32 bits. An empty table gives an empty
    result; other columns are ignored. What stays may begin or end inside a character.
    """
    if length < 2:
        raise ValueError("length is at least 2")
    found = repeated_windows(docs, id_col, text_col, length=length).groupBy("id", "version").agg(F.collect_list(F.struct("start", "n")).alias("repeats"))
    found = persisted(found.withColumnsRenamed({"id": "i", "version": "v"}))
    base = _ordered(docs, id_col, text_col).hint("merge").join(found, (F.col("id") == F.col("i")) & (F.col("version") == F.col("v")), "left")
    out = base.select(F.col("doc_id").alias("id"), "raw", "repeats").mapInArrow(_cut(length), _OUT)
    return out.withColumnRenamed("id", id_col)
