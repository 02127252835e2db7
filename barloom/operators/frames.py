"""Frames of any length in linear time, order statistics of sliding frames, and long series that are split over tasks.

Spark evaluates a frame of the last n rows anew for each row, and an array of its values costs as much to build. Here a row's cost doesn't grow with n:

* Sums, means, deviations and extremes: rows are cut into blocks of n, so that a frame is the end of one block and the beginning of the next (van Herk). Running values from
  both ends of every block are merged. Nothing that lies outside of a frame enters its value, so there is no cancellation.
* Ranks and order statistics: a wavelet matrix over the ranks of a run of values counts those below a bound, or finds the k-th, in any frame by one step per bit.

Rows are dealt by key, or with split by key and block of rows; then each block brings the rows before it that its frames reach (a halo), so that one long series is many tasks.
Tasks hold a batch of rows and one halo.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from barloom.operators.rolling import S, Series

# What runs in tasks travels by value, so that executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that are worked on at once, for each row of the longest frame and at least.
TIMES, LEAST = 3, 8192
KINDS = ("count", "sum", "mean", "std", "max", "min", "since_max", "share_at_most", "share_below", "kth")


@dataclass(frozen=True)
class Frame:
    """A column name: what of the last n rows of a column. Nulls take no part.

    count, sum, mean, std (of a sample), max and min are those of Spark. since_max is the number of rows since the latest highest value. share_at_most is the share of values at most the present
    one, share_below that of the others that are smaller; both are null unless the frame has n values and the present row one. kth is the smallest value but floor(share * (values - 1)).
    """

    name: str
    of: str
    n: int
    what: str
    share: float = 0.0

    def __post_init__(self) -> None:
        if self.what not in KINDS or self.n < 1:
            raise ValueError(f"what is one of {', '.join(KINDS)}, and n at least 1")


def _halves(x: np.ndarray, n: int, fill: float) -> tuple[np.ndarray, int]:
    """Rows of series, cut into blocks of n: (series, blocks, n), with fill behind the end."""
    k, m = x.shape
    blocks = -(-m // n)
    out = np.full((k, blocks * n), fill, x.dtype)
    out[:, :m] = x
    return out.reshape(k, blocks, n), m


def _ends(up: np.ndarray, down: np.ndarray, m: int, nothing: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row: the running value of its block so far, and of the block before from the frame's first row on; nothing where the block holds all of the frame."""
    k, blocks, n = up.shape
    here = up.reshape(k, -1)[:, :m]
    before = np.full((k, blocks * n), nothing, up.dtype)
    flat = down.reshape(k, -1)
    before[:, n - 1 :] = flat[:, : flat.shape[1] - n + 1]
    before[:, n - 1 :: n] = nothing  # the frame is the block
    return here, before[:, :m]


def _extreme(x: np.ndarray, n: int, pick: np.ufunc, nothing: float) -> np.ndarray:
    cut, m = _halves(x, n, nothing)
    return pick(*_ends(pick.accumulate(cut, axis=2), pick.accumulate(cut[:, :, ::-1], axis=2)[:, :, ::-1], m, nothing))


def _moments(x: np.ndarray, valid: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count, mean, sum of squares about the mean) of each frame. Both halves are taken about a value of their own, which the frame holds."""
    (cut, m), (ok, _) = _halves(np.where(valid, x, 0.0), n, 0.0), _halves(valid, n, False)
    parts = []
    for flip in (1, -1):
        c, v = cut[:, :, ::flip], ok[:, :, ::flip]
        pivot = np.take_along_axis(c, v.argmax(axis=2)[:, :, None], axis=2)
        c = np.where(v, c - pivot, 0.0)
        parts.append([np.cumsum(v, axis=2, dtype=np.float64)[:, :, ::flip], np.cumsum(c, axis=2)[:, :, ::flip], np.cumsum(c * c, axis=2)[:, :, ::flip], np.broadcast_to(pivot, c.shape)])
    (n1, n2), (s1, s2), (q1, q2), (p1, p2) = (_ends(a, b, m, 0.0) for a, b in zip(*parts))
    with np.errstate(invalid="ignore", divide="ignore"):
        mean1, mean2 = p1 + s1 / n1, p2 + s2 / n2
        rest1, rest2 = np.maximum(q1 - s1 * s1 / n1, 0.0), np.maximum(q2 - s2 * s2 / n2, 0.0)
        total = n1 + n2
        delta = mean2 - mean1
        mean = np.where(n1 == 0, mean2, np.where(n2 == 0, mean1, mean1 + delta * (n2 / total)))
        rest = np.where(n1 == 0, rest2, np.where(n2 == 0, rest1, rest1 + rest2 + delta * delta * (n1 * n2 / total)))
    return total, mean, rest


class Wavelet:
    """Counts of ranks below a bound, and k-th ranks, between any two places of each row of a matrix of ranks."""

    def __init__(self, ranks: np.ndarray):
        self.levels = []
        self.bits = max(1, int(ranks.shape[1] - 1).bit_length())
        for bit in range(self.bits - 1, -1, -1):
            ones = (ranks >> bit) & 1
            zeros = np.zeros((ranks.shape[0], ranks.shape[1] + 1), np.int64)
            np.cumsum(1 - ones, axis=1, out=zeros[:, 1:])
            self.levels.append(zeros)
            ranks = np.take_along_axis(ranks, np.argsort(ones, axis=1, kind="stable"), axis=1)

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many ranks in places low to high - 1 are less than bound."""
        out = np.zeros(bound.shape, np.int64)
        for k, zeros in enumerate(self.levels):
            one = (bound >> (self.bits - 1 - k)) & 1 == 1
            a, b, all_zeros = np.take_along_axis(zeros, low, axis=1), np.take_along_axis(zeros, high, axis=1), zeros[:, -1:]
            out += np.where(one, b - a, 0)
            low, high = np.where(one, all_zeros + low - a, a), np.where(one, all_zeros + high - b, b)
        return np.where(bound >> self.bits > 0, high - low + out, out)

    def kth(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The rank that k others in places low to high - 1 are smaller than."""
        out = np.zeros(k.shape, np.int64)
        for level, zeros in enumerate(self.levels):
            a, b, all_zeros = np.take_along_axis(zeros, low, axis=1), np.take_along_axis(zeros, high, axis=1), zeros[:, -1:]
            one = k >= b - a
            out |= np.where(one, 1 << (self.bits - 1 - level), 0)
            k = np.where(one, k - (b - a), k)
            low, high = np.where(one, all_zeros + low - a, a), np.where(one, all_zeros + high - b, b)
        return out


class _Column:
    """A column of several series of about one length, as rows of a matrix; what frames share is computed once."""

    def __init__(self, x: np.ndarray, valid: np.ndarray):
        self.x, self.valid = x, valid
        self._moments: dict[int, tuple[np.ndarray, ...]] = {}
        self._order = self._wavelet = None

    def moments(self, n: int) -> tuple[np.ndarray, ...]:
        if n not in self._moments:
            self._moments[n] = _moments(self.x, self.valid, n)
        return self._moments[n]

    def ranks(self) -> tuple[np.ndarray, np.ndarray]:
        """(rank of each place, later ones of equal values higher and nulls last; place by rank)."""
        if self._order is None:
            by_value = np.argsort(np.where(self.valid, self.x, np.inf), axis=1, kind="stable")
            order = np.take_along_axis(by_value, np.argsort(~np.take_along_axis(self.valid, by_value, axis=1), axis=1, kind="stable"), axis=1)
            rank = np.empty_like(order)
            np.put_along_axis(rank, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), axis=1)
            self._order = rank, order
        return self._order

    def wavelet(self) -> Wavelet:
        if self._wavelet is None:
            self._wavelet = Wavelet(self.ranks()[0])
        return self._wavelet

    def _tied(self) -> tuple[np.ndarray, np.ndarray]:
        """(ranks below each value, ranks up to it)."""
        rank, order = self.ranks()
        sorted_x = np.take_along_axis(self.x, order, axis=1)
        place = np.broadcast_to(np.arange(order.shape[1]), order.shape)
        new = np.ones(order.shape, bool)
        new[:, 1:] = sorted_x[:, 1:] != sorted_x[:, :-1]
        low = np.maximum.accumulate(np.where(new, place, 0), axis=1)
        last = np.ones(order.shape, bool)
        last[:, :-1] = new[:, 1:]
        high = np.minimum.accumulate(np.where(last, place + 1, order.shape[1])[:, ::-1], axis=1)[:, ::-1]
        return np.take_along_axis(low, rank, axis=1), np.take_along_axis(high, rank, axis=1)

    def frame(self, f: Frame) -> tuple[np.ndarray, np.ndarray]:
        """(values, where there is one)."""
        if f.what in ("count", "sum", "mean", "std"):
            count, mean, rest = self.moments(f.n)
            if f.what == "count":
                return count, np.ones(count.shape, bool)
            if f.what == "std":
                with np.errstate(invalid="ignore", divide="ignore"):
                    return np.sqrt(rest / (count - 1)), count > 1
            return (mean if f.what == "mean" else mean * count), count > 0
        there = self.moments(f.n)[0] > 0
        if f.what == "max":
            return _extreme(np.where(self.valid, self.x, -np.inf), f.n, np.maximum, -np.inf), there
        if f.what == "min":
            return _extreme(np.where(self.valid, self.x, np.inf), f.n, np.minimum, np.inf), there
        rank, order = self.ranks()
        place = np.broadcast_to(np.arange(rank.shape[1]), rank.shape)
        if f.what == "since_max":
            top = _extreme(np.where(self.valid, rank, -1), f.n, np.maximum, -1)
            return (place - np.take_along_axis(order, np.maximum(top, 0), axis=1)).astype(np.float64), there
        low, high, count = np.maximum(place - f.n + 1, 0), place + 1, self.moments(f.n)[0]
        if f.what == "kth":
            k = np.floor((count - 1) * f.share).astype(np.int64)
            return np.take_along_axis(self.x, np.take_along_axis(order, self.wavelet().kth(low, high, np.maximum(k, 0)), axis=1), axis=1), there
        less, up_to = self._tied()
        full = self.valid & (count == f.n)
        if f.what == "share_at_most":
            return self.wavelet().below(low, high, up_to) / f.n, full
        return self.wavelet().below(low, high, less) / max(1, f.n - 1), full


def _rows_of(starts: np.ndarray, total: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, which of them exist) of series of about one length at once: matrices with a series in each row."""
    sizes = np.diff(starts, append=total)
    classes = np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    for c in np.unique(classes):
        own = np.flatnonzero(classes == c)
        span = np.arange(sizes[own].max())
        there = span < sizes[own][:, None]
        yield np.where(there, starts[own][:, None] + span, 0), there


def compute(columns: Mapping[str, tuple[np.ndarray, np.ndarray]], starts: np.ndarray, total: int, frames: Sequence[Frame]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Frames over series that stand one after the other and begin at starts: {name: (values, where there is one)}."""
    out = {f.name: (np.zeros(total), np.zeros(total, bool)) for f in frames}
    for places, there in _rows_of(starts, total):
        known = {c: _Column(x[places], valid[places] & there) for c, (x, valid) in columns.items()}
        for f in frames:
            values, present = known[f.of].frame(f)
            out[f.name][0][places[there]] = values[there]
            out[f.name][1][places[there]] = present[there]
    return out


def _changes(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Where a row's key isn't that of the row before; always for the first."""
    new = np.zeros(batch.num_rows, bool)
    for key in keys:
        a, b = batch.column(key).slice(1), batch.column(key).slice(0, batch.num_rows - 1)
        same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False) | (a.is_null().to_numpy(zero_copy_only=False) & b.is_null().to_numpy(zero_copy_only=False))
        new[1:] |= ~same
    new[:1] = True
    return new


def _apply(frames: Sequence[Frame], keys: Sequence[str]):
    reach = max(f.n for f in frames) - 1
    used = sorted({f.of for f in frames})

    def results(held: pa.Table, known: int) -> tuple[pa.RecordBatch, pa.Table]:
        """The rows from known on with their frames, and the halo of what comes next."""
        batch = held.combine_chunks().to_batches()[0]
        starts = np.flatnonzero(_changes(batch, keys))
        columns = {}
        for c in used:
            column = batch.column(f"_of_{c}")
            columns[c] = pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False), ~column.is_null().to_numpy(zero_copy_only=False)
        found = compute(columns, starts, batch.num_rows, frames)
        rows = batch.slice(known).select([c for c in batch.schema.names if not c.startswith("_of_")])
        arrays = [*rows.columns, *(pa.array(found[f.name][0][known:], mask=~found[f.name][1][known:]) for f in frames)]
        out = pa.RecordBatch.from_arrays(arrays, [*rows.schema.names, *(f.name for f in frames)])
        return out, held.slice(max(int(starts[-1]), held.num_rows - reach))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halo, waiting = None, []
        for b in batches:
            waiting.append(b)
            if sum(x.num_rows for x in waiting) >= max(LEAST, TIMES * reach):
                out, halo = results(pa.Table.from_batches([*(halo.to_batches() if halo else []), *waiting]), halo.num_rows if halo else 0)
                waiting = []
                yield out
        if sum(x.num_rows for x in waiting):
            yield results(pa.Table.from_batches([*(halo.to_batches() if halo else []), *waiting]), halo.num_rows if halo else 0)[0]

    return run


def running(df: DataFrame, sums: Mapping[str, str | Column] | None = None, highs: Mapping[str, str | Column] | None = None, s: Series = S, order: Sequence[str] = (), chunk_seconds: int = 86_400) -> DataFrame:
    """Running sums and highest values over a series so far, with its rows split by time: within chunks of chunk_seconds by a window, and from chunk to chunk by the chunks' totals,
    of which one small table is scanned in order. order breaks ties of time.

    Nulls take no part; a sum without values is null.
    """
    sums, highs = dict(sums or {}), dict(highs or {})
    wanted = [(n, F.sum, x) for n, x in sums.items()] + [(n, F.max, x) for n, x in highs.items()]
    col = lambda x: F.col(x) if isinstance(x, str) else x
    df = df.withColumn("_chunk", F.floor(F.unix_seconds(F.col(s.ts).cast("timestamp")) / chunk_seconds))
    totals = df.groupBy(s.key, "_chunk").agg(*[f(col(x)).alias(f"_{n}") for n, f, x in wanted])
    before = Window.partitionBy(s.key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col(s.key).alias("_key"), F.col("_chunk").alias("_c"), *[f(f"_{n}").over(before).alias(f"_{n}") for n, f, _ in wanted])
    inside = Window.partitionBy(s.key, "_chunk").orderBy(s.ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.select(*df.columns, *[f(col(x)).over(inside).alias(n) for n, f, x in wanted])
    rows = rows.join(carry, rows[s.key].eqNullSafe(carry["_key"]) & (rows["_chunk"] == carry["_c"]))
    both = {n: F.when(F.col(n).isNull(), F.col(f"_{n}")).when(F.col(f"_{n}").isNull(), F.col(n)).otherwise(F.col(n) + F.col(f"_{n}") if f is F.sum else F.greatest(n, f"_{n}")) for n, f, _ in wanted}
    return rows.withColumns(both).drop("_chunk", "_key", "_c", *[f"_{n}" for n, _, _ in wanted])


def add_frames(df: DataFrame, frames: Sequence[Frame], s: Series = S, order: Sequence[str] = (), split: int | None = None, chunk_seconds: int = 86_400) -> DataFrame:
    """The rows with a column (double) for each frame. order breaks ties of time.

    With split, series are cut into blocks of that many rows (at least as many as the longest frame), each with its halo, so that a key with a great share of all rows, or the only
    series there is, goes to many tasks; rows are numbered by running(). Values of frames are the same.
    """
    frames = list(frames)
    if not frames:
        return df
    used = {c: F.col(c).cast("double").alias(f"_of_{c}") for c in sorted({f.of for f in frames})}
    keys = [s.key]
    if split is not None:
        reach = max(f.n for f in frames) - 1
        size = max(split, reach, 1)
        rows = running(df, {"_row": F.lit(1)}, s=s, order=order, chunk_seconds=chunk_seconds).withColumn("_row", F.col("_row") - 1)
        block = F.floor(F.col("_row") / size)
        halo = F.when((F.col("_row") % size >= size - reach) & F.lit(reach > 0), F.array(block, block + 1)).otherwise(F.array(block))
        rows = rows.select("*", F.explode(halo).alias("_block"))
        keys = [s.key, "_block"]
        rows = rows.repartition(*keys).sortWithinPartitions(*keys, "_row")
    else:
        rows = df.repartition(s.key).sortWithinPartitions(s.key, s.ts, *order)
    schema = StructType([*rows.schema.fields, *[StructField(f.name, DoubleType()) for f in frames]])
    out = rows.select("*", *used.values()).mapInArrow(_apply(frames, keys), schema)
    return out if split is None else out.where(F.col("_block") == F.floor(F.col("_row") / size)).drop("_block", "_row")
