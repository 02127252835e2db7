"""Substring dedup by hashing lines, or units within lines.

A text is cut into units: lines, or pieces of lines that end at a clause or sentence mark. Units are normalised to their words (runs of letters
and digits, A-Z lower-cased) and hashed. Digests are grouped globally with the smallest identifier that has them; the first occurrence there is the
earliest, every other one is a repeat. Neighbouring repeats form runs, and runs of enough words are removed, with their offsets in the original text
retained; shorter ones, such as a stock phrase in prose, stay. With whole_lines, a line that occurs earlier as a whole line goes as well,
however short it is and whatever stands beside it.

The unit "passage" finds what was pasted without regard to marks and lines. Pieces end at words whose hash is the least of some WINDOW neighbouring
words, which depends on nearby words only. Digests are of two neighbouring pieces, so that those of a run follow each other elsewhere too, and
both ends of a run go on word by word while the text at the earliest occurrence of its end does.

Texts are taken in chunks, whose code points, words, units and digests are numpy arrays.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import join_counted, persisted, superseded
from barloom.llm.near_dedup import mix, powers, word_hashes

# The marks that end a unit.
MARKS = {"line": "\n", "sentence": "\n.?!", "clause": "\n.?!,;:"}
UNITS = (*MARKS, "passage")
#: Added to the number of a line, so that lines have places of their own.
LINE = 1 << 30
#: Words among which one ends a piece, and words to which a run may be extended at either end. Of 5 x WINDOW - 2 pasted words two neighbouring pieces are whole.
WINDOW, REACH = 10, 24
#: Code points that are cut at once; a longer text stands alone.
CHUNK = 1 << 20

_OTHER, _WORD, _SPACE = 0, 1, 2


@functools.cache
def _kinds() -> np.ndarray:
    """By code point: of a word (letters and numbers), white space, or neither."""
    every = "".join(map(chr, range(0x110000)))
    out = np.zeros(len(every), np.uint8)
    for kind, pattern in ((_WORD, r"[\p{L}\p{N}]+"), (_SPACE, r"\s+")):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    return out


def _sliding(smaller_or_larger: np.ufunc, values: np.ndarray) -> np.ndarray:
    """The least or greatest of every WINDOW neighbouring values."""
    n = len(values) - WINDOW + 1
    out = values[:n].copy()
    for k in range(1, WINDOW):
        smaller_or_larger(out, values[k : k + n], out=out)
    return out


@dataclass
class Cut:
    """A sequence of units over the words of a chunk: words first to end - 1, of text doc; number counts within the text."""

    first: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    number: np.ndarray


class Chunk:
    """Words of several texts, which stand in one array of code points with a line break after each."""

    def __init__(self, texts: list[str]):
        self.points = np.frombuffer("".join(f"{t}\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.kind = _kinds()[self.points]
        lower = np.where((self.points >= 65) & (self.points <= 90), self.points + 32, self.points)
        self.word, self.start, self.stop = word_hashes(mix(lower.astype(np.uint64) + np.uint64(1)), self.kind == _WORD)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.offset = np.concatenate([[0], ends[:-1]])
        self.doc = np.searchsorted(ends, self.start, "right")
        self.first_word = np.searchsorted(self.doc, np.arange(len(texts) + 1))

    def _split(self, last: np.ndarray) -> Cut:
        """Units that end with the words where last holds, and with each text."""
        if len(last):
            last = last | np.concatenate([self.doc[1:] != self.doc[:-1], [True]])
        end = np.flatnonzero(last) + 1
        first = np.concatenate([[0], end[:-1]]).astype(end.dtype)[: len(end)]
        doc = self.doc[first]
        return Cut(first, end, doc, np.arange(len(first)) - np.searchsorted(doc, doc))

    def _ends_by(self, marks: str) -> np.ndarray:
        before = np.isin(self.points, [ord(c) for c in marks]).cumsum()[self.start]
        return np.concatenate([before[1:] != before[:-1], [True]]) if len(before) else np.zeros(0, bool)

    @functools.cached_property
    def lines(self) -> Cut:
        return self._split(self._ends_by("\n"))

    def pieces(self, unit: str) -> Cut:
        if unit != "passage":
            return self._split(self._ends_by(MARKS[unit]))
        n = len(self.word)
        if n < WINDOW:
            return self._split(np.zeros(n, bool))
        least = np.where(self.doc[: n - WINDOW + 1] == self.doc[WINDOW - 1 :], _sliding(np.minimum, self.word), np.uint64(0))
        none = np.zeros(WINDOW - 1, np.uint64)
        return self._split(self.word == _sliding(np.maximum, np.concatenate([none, least, none])))

    def units(self, unit: str, pieces: Cut) -> Cut:
        """What is hashed: the pieces, or for passages every two neighbours."""
        if unit != "passage":
            return pieces
        left = np.flatnonzero(pieces.doc[1:] == pieces.doc[:-1])
        return Cut(pieces.first[left], pieces.end[left + 1], pieces.doc[left], pieces.number[left])

    def digests(self, of: Cut, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Independent hashes of 64 and 32 bits of the words of every unit."""
        up, down = powers(len(self.word))
        out = []
        for k in (0, 1):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.word + np.uint64(k)) * up)])
            own = (total[of.end] - total[of.first]) * down[of.first]
            out.append(mix(own + (of.end - of.first).astype(np.uint64) + np.uint64(seed << 32)))
        return out[0].view(np.int64), (out[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def spans(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where runs of words start and stop in the chunk. A span goes from its first word, or the line's first character that isn't white space if no word stands
        before, to the marks right behind its last word, or the line's last such character if no word follows."""
        line = np.cumsum(self.points == 10)[self.start]
        breaks = np.flatnonzero(self.points == 10)
        ink, edge = np.flatnonzero(self.kind != _SPACE), np.flatnonzero(self.kind != _OTHER)
        last = end - 1
        opens = (first == 0) | (line[np.maximum(first - 1, 0)] != line[first])
        closes = (end == len(line)) | (line[np.minimum(end, len(line) - 1)] != line[last])
        before = np.where(line[first] > 0, breaks[line[first] - 1] + 1, 0)
        start = np.where(opens, ink[np.searchsorted(ink, before)], self.start[first])
        stop = np.where(closes, ink[np.searchsorted(ink, breaks[line[last]]) - 1] + 1, edge[np.minimum(np.searchsorted(edge, self.stop[last]), len(edge) - 1)])
        return start, stop


def _chunks(texts: list[str | None], wanted: list[int]) -> Iterator[tuple[list[int], Chunk]]:
    """The wanted texts in chunks, with their numbers."""
    part, held = [], 0
    for k in wanted:
        if part and held + len(texts[k]) > CHUNK:
            yield part, Chunk([texts[i] for i in part])
            part, held = [], 0
        part.append(k)
        held += len(texts[k]) + 1
    if part:
        yield part, Chunk([texts[i] for i in part])


def _unit_rows(unit: str, whole_lines: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, versions = b.column("id"), b.column("version")
            for rows, chunk in _chunks(b.column("text").to_pylist(), list(range(b.num_rows))):
                parts = [(chunk.units(unit, chunk.pieces(unit)), 0, 0)] + ([(chunk.lines, LINE, 1)] if whole_lines else [])
                digests = [chunk.digests(cut, seed) for cut, _, seed in parts]
                every = lambda of: np.concatenate([of(cut) for cut, _, _ in parts])
                doc, first, words = every(lambda c: c.doc), every(lambda c: c.first), every(lambda c: c.end - c.first)
                position = np.concatenate([cut.number + add for cut, add, _ in parts]).astype(np.int32)
                one, two = (np.concatenate(x) for x in zip(*digests))
                fresh = np.zeros(len(doc), bool)
                fresh[np.unique(mix(one.view(np.uint64) + mix(doc.astype(np.uint64))), return_index=True)[1]] = True  # parts stand in page order
                at = (first - chunk.first_word[doc]).astype(np.int32)
                row = np.array(rows)[doc] if len(doc) else doc
                for k in range(0, len(doc), 50_000):
                    part = slice(k, k + 50_000)
                    take = pa.array(row[part])
                    yield pa.RecordBatch.from_pydict({
                        "id": ids.take(take), "version": versions.take(take), "position": pa.array(position[part]), "at": pa.array(at[part]), "words": pa.array(words[part].astype(np.int32)),
                        "d1": pa.array(one[part]), "d2": pa.array(two[part]), "fresh": pa.array(fresh[part]),
                    })

    return run


_UNITS = "id bigint, version int, position int, at int, words int, d1 bigint, d2 int, fresh boolean"
_END = "first bigint, d1 bigint, d2 int"
_RUNS = f"id bigint, version int, low int, high int, left struct<{_END}>, right struct<{_END}>"


def _runs(least_words: int):
    """(id, version, low, high, left, right): runs of neighbouring places of enough words, with what occurs earlier at either end; lines alone, without ends."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            again = b.column("again")
            doc = np.repeat(np.arange(b.num_rows), np.diff(again.offsets.to_numpy()))
            flat = again.flatten()
            position, at, words, first, d1, d2 = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("position", "at", "words", "first", "d1", "d2"))
            order = np.lexsort((position, doc))
            doc, position, at, words, first, d1, d2 = (x[order] for x in (doc, position, at, words, first, d1, d2))
            head = np.ones(len(doc), bool)
            head[1:] = (doc[1:] != doc[:-1]) | (position[1:] != position[:-1] + 1) | (position[1:] >= LINE)
            low = np.flatnonzero(head)
            high = np.concatenate([low[1:], [len(doc)]])[: len(low)] - 1
            good = (position[low] >= LINE) | (at[high] + words[high] - at[low] >= least_words)
            low, high = low[good], high[good]
            take = pa.array(doc[low])

            def ends(k: np.ndarray) -> pa.StructArray:
                return pa.StructArray.from_arrays([pa.array(x[k]) for x in (first, d1, d2)], ["first", "d1", "d2"], mask=pa.array(position[k] >= LINE))

            yield pa.RecordBatch.from_pydict({"id": b.column("id").take(take), "version": b.column("version").take(take), "low": pa.array(position[low]), "high": pa.array(position[high]), "left": ends(low), "right": ends(high)})

    return run


def _context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first, d1, d2, before, after): hashes of the words on either side of the first occurrence of two neighbouring pieces."""
    for b in batches:
        ids, wanted = b.column("id"), b.column("wanted")
        for rows, chunk in _chunks(b.column("text").to_pylist(), list(range(b.num_rows))):
            pairs = chunk.units("passage", chunk.pieces("passage"))
            one, two = chunk.digests(pairs, 0)
            bounds, out = np.searchsorted(pairs.doc, np.arange(len(rows) + 1)), []
            for k, row in enumerate(rows):
                low, high = chunk.first_word[k], chunk.first_word[k + 1]
                own, order = one[bounds[k] : bounds[k + 1]], None
                order = np.argsort(own, kind="stable")
                for x in wanted[row].as_py():
                    at = np.searchsorted(own[order], x["d1"]) if len(own) else 0
                    if at < len(own) and own[order[at]] == x["d1"] and two[bounds[k] + order[at]] == x["d2"]:  # else it is another version of the document
                        i, j = pairs.first[bounds[k] + order[at]], pairs.end[bounds[k] + order[at]]
                        out.append((ids[row].as_py(), x["d1"], x["d2"], chunk.word[max(low, i - REACH) : i].view(np.int64), chunk.word[j : min(high, j + REACH)].view(np.int64)))
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], ["first", "d1", "d2", "before", "after"])


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, unit: str = "clause", least_words: int = 15, whole_lines: bool = False) -> DataFrame:
    """(id, version, runs array<struct<low, high, before, after>>): for each document the runs of units, low to high, that occur earlier and have at least least_words words,
    for passages with hashes of the words around the earliest occurrence of the run's ends; with whole_lines also all lines that occur earlier, at LINE plus their number.

    version is the hash of the text. Rows with a null identifier or text take no part. Texts aren't shuffled, only digests and places; for passages also the texts with earliest
    occurrences of ends.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), F.hash(F.col(text_col)).alias("version"), F.col(text_col).alias("text")).where(F.col("id").isNotNull() & F.col("text").isNotNull())
    units = persisted(base.mapInArrow(_unit_rows(unit, whole_lines), _UNITS))
    # Only digests that occur again go on. Those with a great share of all rows, of which there are few, meet their occurrences by broadcast, so that no task of the join below has many rows of one digest.
    ranked = persisted(units.groupBy("d1", "d2").agg(F.min("id").alias("first"), F.count("*").alias("n")).where(F.col("n") > 1))
    same = lambda x: (F.col("one") == x["d1"]) & (F.col("two") == x["d2"])
    again = join_counted(units.withColumnsRenamed({"d1": "one", "d2": "two"}), ranked, same, units.count())
    again = again.where((F.col("id") != F.col("first")) | ~F.col("fresh")).select("id", "version", "position", "at", "words", "first", "d1", "d2")
    # Dealt once. Rows that repeat an identifier and text give the same places.
    grouped = again.repartition("id", "version").distinct().groupBy("id", "version").agg(F.collect_list(F.struct("position", "at", "words", "first", "d1", "d2")).alias("again"))
    runs = persisted(grouped.mapInArrow(_runs(least_words), _RUNS))
    superseded(units, ranked)
    nothing = F.lit(None).cast("array<bigint>")
    known = runs.select("id", "version", "low", "high", nothing.alias("before"), nothing.alias("after"))
    if unit == "passage":
        ends = runs.where(F.col("left").isNotNull()).select("id", "version", "low", "high", F.explode(F.array(F.struct(F.lit(True).alias("before"), F.col("left").alias("at")), F.struct(F.lit(False).alias("before"), F.col("right").alias("at")))).alias("end"))
        ends = ends.select("id", "version", "low", "high", F.col("end.before").alias("is_left"), "end.at.*")
        wanted = ends.select("first", "d1", "d2").distinct().groupBy("first").agg(F.collect_list(F.struct("d1", "d2")).alias("wanted"))
        texts = base.select("id", "text").join(persisted(wanted.withColumnRenamed("first", "id")).hint("merge"), "id")
        context = texts.mapInArrow(_context, f"{_END}, before array<bigint>, after array<bigint>")
        # Versions of a document may stand in other words; one of them is taken.
        context = persisted(context.groupBy("first", "d1", "d2").agg(F.min("before").alias("before"), F.min("after").alias("after")))
        around = ends.join(context.hint("merge"), ["first", "d1", "d2"]).select("id", "version", "low", "high", F.when(F.col("is_left"), F.col("before")).alias("before"), F.when(~F.col("is_left"), F.col("after")).alias("after"))
        known = known.where(F.col("low") >= LINE).unionByName(around)
    return known.groupBy("id", "version").agg(F.collect_list(F.struct("low", "high", "before", "after")).alias("runs"))


def _alike(one: np.ndarray, other: np.ndarray) -> int:
    """How many words at the start are the same."""
    n = min(len(one), len(other))
    different = np.flatnonzero(one[:n] != other[:n])
    return int(different[0]) if len(different) else n


def _cut(unit: str):
    wide = 2 if unit == "passage" else 1

    def gone_words(chunk: Chunk, known: list[list[dict]]) -> np.ndarray:
        """By word of the chunk: it is removed."""
        gone = np.zeros(len(chunk.word), bool)
        pieces = chunk.pieces(unit)
        number = np.arange(len(known))
        piece, line = np.searchsorted(pieces.doc, number), np.searchsorted(chunk.lines.doc, number)
        hashes = chunk.word.view(np.int64)
        for k, runs in enumerate(known):
            low, high = chunk.first_word[k], chunk.first_word[k + 1]
            for r in runs:
                if r["low"] >= LINE:
                    at = line[k] + r["low"] - LINE
                    gone[chunk.lines.first[at] : chunk.lines.end[at]] = True
                    continue
                i, j = pieces.first[piece[k] + r["low"]], pieces.end[piece[k] + r["high"] + wide - 1]
                if r["before"]:
                    i -= _alike(hashes[max(low, i - REACH) : i][::-1], np.array(r["before"][::-1]))
                if r["after"]:
                    j += _alike(hashes[j : min(high, j + REACH)], np.array(r["after"]))
                gone[i:j] = True
        return gone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, runs = b.column("text").to_pylist(), b.column("runs")
            removed, words = [[] for _ in texts], [0] * len(texts)
            touched = [k for k in range(b.num_rows) if runs[k].is_valid and texts[k] is not None]
            for rows, chunk in _chunks(texts, touched):
                gone = gone_words(chunk, [runs[k].as_py() for k in rows])
                edge = np.concatenate([[True], chunk.doc[1:] != chunk.doc[:-1], [True]]) if len(gone) else np.ones(1, bool)  # no span goes on into the next text
                here, before = np.concatenate([gone, [False]]), np.concatenate([[False], gone])
                first, end = np.flatnonzero(here & (~before | edge)), np.flatnonzero(before & (~here | edge))
                if not len(first):
                    continue
                start, stop = chunk.spans(first, end)
                doc = chunk.doc[first]
                for i, k in enumerate(doc.tolist()):
                    n = int(end[i] - first[i])
                    removed[rows[k]].append({"start": int(start[i] - chunk.offset[k]), "stop": int(stop[i] - chunk.offset[k]), "words": n})
                    words[rows[k]] += n
            for k in touched:
                starts, stops = [0, *(s["stop"] for s in removed[k])], [*(s["start"] for s in removed[k]), len(texts[k])]
                texts[k] = "".join(texts[k][i:j] for i, j in zip(starts, stops))
            yield pa.RecordBatch.from_pydict({"id": b.column("id"), "text": pa.array(texts, pa.string()), "removed": pa.array(removed, _SPANS), "n_removed_words": pa.array(words, pa.int64())})

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("words", pa.int64())]))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, unit: str = "clause", least_words: int = 15, whole_lines: bool = False) -> DataFrame:
    """(id_col, text_col, removed array<struct<start, stop, words>>, n_removed_words) for every row: the text without its repeats.

    unit is "line", "sentence", "clause" or "passage" (see above). whole_lines removes repeated lines without regard to least_words as well. The earliest occurrence stays: the first
    in the document with the smallest identifier. Offsets are code points of the original text, stop exclusive. Null texts stay null and have nothing removed; so do rows with a null
    identifier. Repeated rows get the same result; an identifier with several texts is one document with versions, which repeat themselves, but not each other. An empty table gives
    an empty result. Other columns are ignored.
    """
    if unit not in UNITS:
        raise ValueError(f"unit is one of {', '.join(UNITS)}")
    base = docs.select(F.col(id_col).cast("bigint").alias("id"), F.hash(F.col(text_col)).alias("version"), F.col(text_col).alias("text"))
    known = persisted(repeats(docs, id_col, text_col, unit=unit, least_words=least_words, whole_lines=whole_lines))
    out = base.join(known.hint("merge"), ["id", "version"], "left").mapInArrow(_cut(unit), "id bigint, text string, removed array<struct<start:int,stop:int,words:bigint>>, n_removed_words bigint")
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "removed", "n_removed_words")
