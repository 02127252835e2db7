"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every document becomes a fixed row of statistics of its whole text. Trees are grown on binned statistics of a bounded sample of
labelled rows, level by level to a fixed depth, and flattened into arrays (split feature and threshold of every inner node,
value of every leaf), so that a batch of documents walks all trees with vectorised numpy indexing.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import whole_row
from barloom.llm.near_dedup import follow, mix, powers, word_hashes

#: Names of the statistics, in the order of a row.
STATISTICS = (
    "log_bytes", "log_words", "mean_word", "std_word", "longest_word", "upper_share", "digit_share", "punctuation_share", "symbol_share", "bang_share", "pipe_share",
    "beyond_ascii_share", "space_share", "type_share", "top_word_share", "top_five_share", "repeated_pair_share", "echo_share", "log_lines", "repeated_line_share", "mean_line", "full_stop_share",
    "shouted_share", "capital_share", "bare_share", "period_two_share",
)


#: Code points whose statistics are taken at once; a longer text stands alone.
CHUNK = 1 << 18
_SPACE, _UPPER, _LOWER, _ALNUM = 1, 2, 4, 8
#: Kinds of ASCII characters: capital, small letter, digit, white space, symbol, !, |, full stop, other; all else is beyond.
_ASCII_KINDS = 10


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: flags of str.isspace, isupper, islower (or title case) and isalnum; and the ASCII kind."""
    flags = np.fromiter((_SPACE * c.isspace() + _UPPER * c.isupper() + _LOWER * (c.islower() or c.istitle() and not c.isupper()) + _ALNUM * c.isalnum() for c in map(chr, range(0x110000))), np.uint8, 0x110000)
    kind = np.full(0x110000, _ASCII_KINDS - 1, np.int8)
    kind[:128] = 8
    for k, chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "\t\n\v\f\r ", "#$%&*@^~<>{}[]\\_=+", "!", "|", ".")):
        kind[[ord(c) for c in chars]] = k
    return flags, kind


def _distinct(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, count, place of one) of every different hash of a text, by text."""
    key = (doc.astype(np.uint64) << np.uint64(45)) | (hashes >> np.uint64(19))  # a chunk has fewer than 2^19 texts
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
    return (key[first] >> np.uint64(45)).astype(np.int64), np.diff(first, append=len(key)), order[first]


def _chunk_statistics(texts: list[str]) -> np.ndarray:
    m = len(texts)
    flags_of, kind_of = _tables()
    point = np.frombuffer("".join(f"{t}\n" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts])
    own = np.repeat(np.arange(m), np.diff(ends, prepend=0))
    flags = flags_of[point]
    kinds = np.bincount(own * _ASCII_KINDS + kind_of[point], minlength=m * _ASCII_KINDS).reshape(m, _ASCII_KINDS).astype(float)
    kinds[:, 3] -= 1  # the line break after each text
    beyond = np.bincount(own, 1.0 * (point > 127) + (point > 0x7FF) + (point > 0xFFFF) + (point > 127), m)  # bytes of characters beyond ASCII
    total = kinds[:, :-1].sum(1) + beyond
    keys = mix(point.astype(np.uint64) + np.uint64(1))
    word, start, stop = word_hashes(keys, (flags & _SPACE) == 0)
    out = np.zeros((m, len(STATISTICS)))
    out[:, 0] = np.log1p(total)
    if not len(word):
        return out
    doc = own[start]
    n = np.bincount(doc, minlength=m).astype(float)
    some = n > 0
    n[~some] = 1  # those rows are blanked at the end
    of = lambda d, weights=None: np.bincount(d, weights, m).astype(float)
    size = (stop - start).astype(float)
    mean = of(doc, size) / n
    longest = np.zeros(m)
    np.maximum.at(longest, doc, size)
    d, times, place = _distinct(doc, word)
    rank = np.lexsort((-times, d))
    nth = np.arange(len(d)) - np.searchsorted(d, d)  # d is in order, and so is d[rank]
    same = doc[1:] == doc[:-1]
    pair = follow(word[:-1], word[1:])[same]
    in_word = lambda flag: np.add.reduceat((flags & flag) > 0, start, dtype=np.int64)  # noqa: E731  white space up to the next word has none of these flags
    upper, lower, alnum = in_word(_UPPER), in_word(_LOWER), in_word(_ALNUM)
    # Lines that have a word, by the number of line breaks before it; a line's hash takes in its white space.
    breaks = np.flatnonzero(point == 10)
    line = np.unique(np.searchsorted(breaks, start))
    up, down = powers(len(point))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(keys * up)])
    low, high = np.where(line > 0, breaks[line - 1] + 1, 0), breaks[line]
    line_doc, line_hash = own[high], mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64))
    lines, different = of(line_doc), of(_distinct(line_doc, line_hash)[0])
    upper_share, lower_share, digit_share, space_share = (kinds[:, k] / np.maximum(total, 1) for k in range(4))
    types = np.maximum(of(d), 1)
    columns = [
        np.log1p(n), mean, np.sqrt(of(doc, (size - mean[doc]) ** 2) / n), longest, upper_share, digit_share, (total - kinds[:, :4].sum(1) - beyond) / np.maximum(total, 1), kinds[:, 4] / np.maximum(total, 1),
        kinds[:, 5] / np.maximum(total, 1), kinds[:, 6] / np.maximum(total, 1), beyond / np.maximum(total, 1), space_share, of(d) / n, of(d[rank][nth == 0], times[rank][nth == 0]) / n, of(d[rank][nth < 5], times[rank][nth < 5]) / n,
        1 - of(_distinct(doc[1:][same], pair)[0]) / np.maximum(1, n - 1), of(doc[1:][same & (word[1:] == word[:-1])]) / n, np.log1p(lines), 1 - different / np.maximum(1, lines), n / np.maximum(1, lines), kinds[:, 7] / n,
        of(doc[(upper > 0) & (lower == 0)]) / n, of(doc[(flags[start] & _UPPER) > 0]) / n, of(d[alnum[place] == 0]) / types, of(doc[2:][(doc[2:] == doc[:-2]) & (word[2:] == word[:-2])]) / n,
    ]
    out[:, 1:] = np.stack(columns, 1)
    out[~some, 1:] = 0
    return out


def statistics(texts: list[str]) -> np.ndarray:
    """(texts, STATISTICS) of whole texts; a text without words has zeros but for its length. Words are told apart by hashes of 45 bits within a text."""
    parts, part, held = [np.zeros((0, len(STATISTICS)))], [], 0
    for text in texts:
        if part and held + len(text) > CHUNK:
            parts.append(_chunk_statistics(part))
            part, held = [], 0
        part.append(text)
        held += len(text) + 1
    return np.concatenate([*parts, _chunk_statistics(part)] if part else parts)


@dataclass(frozen=True)
class Trees:
    """Flattened trees of one depth: feature and threshold are (trees, 2^depth - 1), value is (trees, 2^depth)."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of x."""
        total = np.full(len(x), self.start)
        depth = self.value.shape[1].bit_length() - 1
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - (2**depth - 1)]
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray, *, trees: int = 120, depth: int = 4, rate: float = 0.12, bins: int = 64, smooth: float = 2.0, least: int = 8) -> Trees:
    """Boosted trees for labels y in [0, 1]. With no rows, or one label only, no split gains and the score is constant."""
    inner, leaves = 2**depth - 1, 2**depth
    feature, threshold, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    share = (float(y.sum()) + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        return Trees(start, feature[:0], threshold[:0], value[:0])
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for k in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], 1)  # bin b holds edges[b-1] < x <= edges[b]
    offset = np.arange(width) * bins
    total = np.full(len(y), start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)  # within the level
        for level in range(depth):
            here = 2**level
            slot = ((node[:, None] * width * bins) + offset + binned).ravel()
            shape = (here, width, bins)
            g, h, n = (np.bincount(slot, np.repeat(v, width), here * width * bins).reshape(shape).cumsum(2) for v in (gradient, weight, np.ones(len(y))))
            g_all, h_all, n_all = g[:, :, -1:], h[:, :, -1:], n[:, :, -1:]
            gain = g**2 / (h + smooth) + (g_all - g) ** 2 / (h_all - h + smooth) - g_all**2 / (h_all + smooth)
            gain[(n < least) | (n_all - n < least)] = 0
            best = gain.reshape(here, -1).argmax(1)
            for k in range(here):
                f, b = divmod(int(best[k]), bins)
                at = here - 1 + k
                if gain[k, f, b] > 1e-9 and b < len(edges[f]):
                    feature[t, at], threshold[t, at] = f, edges[f][b]
            at = here - 1 + node
            node = 2 * node + (x[np.arange(len(y)), feature[t, at]] > threshold[t, at])
        g, h = np.bincount(node, gradient, leaves), np.bincount(node, weight, leaves)
        value[t] = rate * g / (h + smooth)
        total += value[t][node]
    return Trees(start, feature, threshold, value)


def _rows(batches: Iterator[pa.RecordBatch], finish) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield finish(b, statistics([t or "" for t in b.column("text").to_pylist()]))


def statistics_of(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in keep and an array<double> of STATISTICS; docs has these columns and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(b: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({name: b.column(name) for name in keep} | {"x": pa.array(list(x), pa.list_(pa.float64()))})

        return _rows(batches, finish)

    kinds = dict(docs.dtypes)
    return docs.select(*keep, "text").mapInArrow(run, ", ".join([*(f"`{name}` {kinds[name]}" for name in keep), "x array<double>"]))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", *, may_learn: Column | None = None, most_rows: int = 20_000) -> Trees:
    """Trees from at most most_rows labelled documents, those with the smallest hash of the identifier.

    may_learn is a condition on `id`. Labels that are null are not used; several labels of one document count by
    their mean; repeated documents repeat. Without usable rows the model scores every document 0.5.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")).where(F.col("id").isNotNull() & F.col("y").isNotNull())
    if may_learn is not None:
        known = known.where(may_learn)
    known = known.groupBy("id").agg(F.avg("y").alias("y"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(most_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")  # at most most_rows rows
    found = statistics_of(rows, ["id", "y"]).orderBy("id").select("x", "y").limit(most_rows).toPandas()
    if found.empty:
        return grow(np.zeros((0, len(STATISTICS))), np.zeros(0))
    return grow(np.stack(found["x"].to_numpy()), found["y"].to_numpy(float))


def quality_scores(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) for every row; null and empty texts are scored by their (zero) statistics.

    Repeated rows and null identifiers keep a row each; an empty table gives an empty result. Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.start, model.feature, model.threshold, model.value))  # plain arrays need no class on executors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(b: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"id": b.column("id"), "score": pa.array(Trees(*shared.value).score(x), pa.float64())})

        return _rows(batches, finish)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, score double").select(F.col("id").alias(id_col), "score")


def accepted(docs: DataFrame, model: Trees, least: float, text_col: str = "text") -> DataFrame:
    """The rows of docs whose score is at least least, with all their columns, whatever their names.

    Null and empty texts are scored by their (zero) statistics, so all of them stay or all go. Repeated rows have the same score. An empty table gives an empty result.
    """
    rows = docs.select(whole_row(docs).alias("row"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast((model.start, model.feature, model.threshold, model.value))  # plain arrays need no class on executors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finish(b: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
            good = pa.array(np.flatnonzero(Trees(*shared.value).score(x) >= least))
            return pa.RecordBatch.from_arrays([b.column("row").take(good)], ["row"])

        return _rows(batches, finish)

    return rows.mapInArrow(run, T.StructType([T.StructField("row", rows.schema["row"].dataType, True)])).select("row.*")
