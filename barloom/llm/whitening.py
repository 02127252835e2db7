"""Whitening of embeddings by the exact characteristic polynomial of their scatter matrix.

1. Vectors become whole numbers, x = floor(scale * entry) + shift. Tasks sum counts, entries and products of entries exactly, in limbs of
   LIMB bits; Spark adds the partial sums by matrix position. n * sum(x x') - S S' is the integer scatter matrix, n^2 times the covariance.
2. Its characteristic polynomial is taken modulo primes of 31 bits, a task for every few primes: reduction to Hessenberg form, then the
   recurrence over leading blocks. Chinese remaindering gives the integer coefficients, as a product of primes above twice their bound is used.
3. All its roots are real, so the sign changes of the polynomial shifted to a point (Descartes) are exactly the number of roots above it, multiple
   ones included. Bisection on such counts isolates the greatest roots; a root that is alone goes on by signs alone, to 2^-WIDTH of the trace.
4. A component is a null vector of the matrix less its root: fixed-point elimination with FRACTION bits and two rounds of inverse iteration; roots that
   no grid point separates share an orthonormal basis. Roots are dealt to tasks.

The matrix and the model are of the size of the dimension, never of the rows: the driver holds these only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import persisted, superseded

LIMB = 20
#: Entries beyond this are taken as this; rows of a block whose products are summed in floating point, exactly, as two limbs and so many rows take 53 bits at most.
LARGEST, BLOCK = 1 << 62, 4096
#: Resolution of roots below the trace, and bits behind the point in elimination.
WIDTH, FRACTION = 128, 320
#: More dimensions than this are refused: the model is of the size of their square.
MOST_DIMENSIONS = 4096


@dataclass(frozen=True)
class Whitening:
    """dimension, rows, scale, integer sums of y = floor(scale * entry), eigenvalues of n^2 V (falling) with their unit vectors as columns, and n^2 trace(V)."""

    dimension: int
    n: int
    scale: int
    sums: list[int]
    roots: list[float]
    components: np.ndarray
    trace: int


def _whole(batch: pa.RecordBatch, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, whole entries) of the vectors of each length; rows that are null or hold entries that aren't finite are left out."""
    column = batch.column("vector")
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null entries are nan
    valid = ~column.is_null().to_numpy(zero_copy_only=False)
    sizes = np.where(valid, sizes, 0)
    start = np.cumsum(sizes) - sizes
    for size in np.unique(sizes[sizes > 0]):
        rows = np.flatnonzero(sizes == size)
        entries = flat[start[rows][:, None] + np.arange(size)]
        fine = np.isfinite(entries).all(axis=1)
        if fine.any():
            with np.errstate(over="ignore"):
                scaled = np.floor(entries[fine] * scale)
            yield rows[fine], np.clip(scaled, -float(LARGEST), float(LARGEST)).astype(np.int64)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """Signed limbs of LIMB bits, lowest first, as floating-point numbers; one for small entries."""
    out = []
    while y.any() or not out:
        low = ((y + (1 << LIMB - 1)) & ((1 << LIMB) - 1)) - (1 << LIMB - 1)
        out.append(low.astype(np.float64))
        y = (y - low) >> LIMB
    return out


_SUMS = "d int, i int, j int, k int, v bigint"


def _partial_sums(scale: int):
    """(d, i, j, k, v): v * 2^(LIMB k) is to be added to entry (i, j) for vectors of length d; i = -1 is the row of sums, with the count at j = -1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for _, y in _whole(b, scale):
                d = y.shape[1]
                for part in (y[k : k + BLOCK] for k in range(0, len(y), BLOCK)):
                    limbs = [np.column_stack([np.full(len(part), float(k == 0)), limb]) for k, limb in enumerate(_limbs(part))]  # the first column counts rows
                    for k, left in enumerate(limbs):
                        for m, right in enumerate(limbs):
                            total = held.setdefault((d, k + m), np.zeros((d + 1, d + 1), np.int64))
                            total += (left.T @ right).astype(np.int64)
        for (d, k), total in held.items():
            i, j = np.nonzero(np.triu(total))
            for at in range(0, len(i), 100_000):
                a, b = i[at : at + 100_000], j[at : at + 100_000]
                full = lambda x: pa.array(np.full(len(a), x, np.int32))
                yield pa.RecordBatch.from_pydict({"d": full(d), "i": pa.array((a - 1).astype(np.int32)), "j": pa.array((b - 1).astype(np.int32)), "k": full(k), "v": pa.array(total[a, b])})

    return run


def _primes(n: int) -> list[int]:
    """The n greatest primes below 2^31 (Miller-Rabin, exact for these bases at this size)."""
    def is_prime(p: int) -> bool:
        odd, twos = p - 1, 0
        while odd % 2 == 0:
            odd, twos = odd // 2, twos + 1
        for base in (2, 3, 5, 7):
            x = pow(base, odd, p)
            if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
                return False
        return True

    out, p = [], (1 << 31) - 1
    while len(out) < n:
        if is_prime(p):
            out.append(p)
        p -= 2
    return out


def characteristic_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(t - matrix) modulo the prime p < 2^31, constant first; matrix holds residues."""
    h, d = matrix.astype(np.uint64) % np.uint64(p), len(matrix)
    q = np.uint64(p)
    for c in range(d - 2):
        below = np.flatnonzero(h[c + 1 :, c])
        if not len(below):
            continue
        pivot = c + 1 + int(below[0])
        if pivot != c + 1:
            h[[c + 1, pivot]] = h[[pivot, c + 1]]
            h[:, [c + 1, pivot]] = h[:, [pivot, c + 1]]
        factor = h[c + 2 :, c] * np.uint64(pow(int(h[c + 1, c]), -1, p)) % q
        h[c + 2 :] = (h[c + 2 :] + (q - factor)[:, None] * h[c + 1] % q) % q
        for part in range(0, d - c - 2, 4):  # up to four products of 62 bits fit
            h[:, c + 1] = (h[:, c + 1] + (h[:, c + 2 + part : c + 6 + part] * factor[part : part + 4] % q).sum(axis=1)) % q
    poly = np.zeros((d + 1, d + 1), np.uint64)  # poly[m]: of the leading m x m block
    poly[0, 0] = 1
    for m in range(1, d + 1):
        poly[m, 1:] = poly[m - 1, :-1]
        poly[m] = (poly[m] + (q - h[m - 1, m - 1]) % q * poly[m - 1] % q) % q
        run = 1
        for back in range(1, m):
            run = run * int(h[m - back, m - back - 1]) % p
            if run == 0:
                break
            poly[m] = (poly[m] + np.uint64(p - run * int(h[m - back - 1, m - 1]) % p) * poly[m - back - 1] % q) % q
    return poly[d]


def _spread(spark: SparkSession, items: int, body, schema: str) -> list:
    """Rows of body(k) for k below items, a few per task."""
    tasks = min(items, 2 * spark.sparkContext.defaultParallelism)
    return spark.range(0, items, 1, tasks).mapInArrow(body, schema).collect()


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(t - matrix) for a symmetric positive semidefinite matrix, constant first."""
    d = len(matrix)
    trace = max(1, sum(matrix[i][i] for i in range(d)))
    # Roots are at least 0 and sum to the trace: coefficient k is at most C(d, k) (trace / k)^k.
    bound = max((math.comb(d, k) * trace**k // k**k for k in range(1, d + 1)), default=1)
    primes = _primes((2 * bound).bit_length() // 30 + 2)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for p in (primes[k] for k in b.column("id").to_pylist()):
                residues = np.array([[x % p for x in row] for row in matrix], np.uint64)
                found.append((p, characteristic_modulo(residues, p).astype(np.int64).tolist()))
            yield pa.RecordBatch.from_pydict({"p": pa.array([p for p, _ in found], pa.int64()), "c": pa.array([c for _, c in found], pa.list_(pa.int64()))})

    by_prime = {r["p"]: r["c"] for r in _spread(spark, len(primes), body, "p bigint, c array<bigint>")}
    whole = math.prod(primes)
    out = [0] * (d + 1)
    for p, residues in by_prime.items():
        rest = whole // p
        unit = rest * pow(rest, -1, p)
        out = [x + unit * r for x, r in zip(out, residues)]
    return [x - whole if x > whole // 2 else x for x in (x % whole for x in out)]


def roots_above(poly: list[int], at: int) -> int:
    """How many roots of a polynomial with real roots only are greater than at: sign changes after the shift."""
    shifted = list(poly)
    for low in range(len(poly) - 1):
        for k in range(len(poly) - 2, low - 1, -1):
            shifted[k] += at * shifted[k + 1]
    signs = [x > 0 for x in shifted if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _value(poly: list[int], at: int) -> int:
    out = 0
    for c in reversed(poly):
        out = out * at + c
    return out


def greatest_roots(poly: list[int], most: int) -> tuple[list[tuple[int, int, int]], int]:
    """((low, high, count), ...), bits: the greatest roots lie in (low, high] / 2^bits, falling, at least most of them if there are; high - low is 1.

    Only positive roots are returned; count is the number of roots that the grid doesn't separate.
    """
    d = len(poly) - 1
    trace = -poly[d - 1] if d else 0
    if trace <= 0:
        return [], 0
    bits = max(0, WIDTH - trace.bit_length())
    scaled = [c << bits * (d - k) for k, c in enumerate(poly)]
    top = trace << bits
    found, done, todo = [], 0, [(0, top + 1, roots_above(scaled, 0), 0)]
    while todo and done < most:
        low, high, above_low, above_high = todo.pop()  # roots in (low, high]
        n = above_low - above_high
        if n == 0:
            continue
        if n == 1 and high - low > 1:
            # The only root: the sign at a point tells on which side of it the root is.
            at_high = _value(scaled, high)
            if at_high == 0:
                low = high - 1
            else:
                while high - low > 1:
                    middle = (low + high) // 2
                    here = _value(scaled, middle)
                    if here == 0:
                        low, high = middle - 1, middle
                    elif (here > 0) == (at_high > 0):
                        high = middle
                    else:
                        low = middle
        if high - low == 1:
            found.append((low, high, n))
            done += n
            continue
        middle = (low + high) // 2
        above = roots_above(scaled, middle)
        todo += [(low, middle, above_low, above), (middle, high, above, above_high)]
    return found, bits


def null_vectors(matrix: list[list[int]], low: int, high: int, bits: int, count: int) -> list[list[float]]:
    """count orthonormal vectors of the space that belongs to the root in (low, high] / 2^bits; the entry of greatest size is positive."""
    d, one = len(matrix), 1 << FRACTION
    size = max(1, max(abs(x) for row in matrix for x in row))
    # The matrix over its greatest entry, less the middle of the interval, in fixed point.
    a = np.array([[(x << FRACTION) // size for x in row] for row in matrix], object)
    shift = ((low + high) << FRACTION) // (size << (bits + 1))
    for i in range(d):
        a[i, i] -= shift
    order, factors = list(range(d)), []
    for c in range(d):
        pivot = c + max(range(d - c), key=lambda k: abs(a[c + k, c]))
        a[[c, pivot]] = a[[pivot, c]]
        order[c], order[pivot] = order[pivot], order[c]
        if a[c, c] == 0:
            a[c, c] = 1  # the least step of the grid
        factor = (a[c + 1 :, c] << FRACTION) // a[c, c]
        a[c + 1 :, c:] -= (factor[:, None] * a[c, c:]) >> FRACTION
        for earlier in factors:
            earlier[1][[c, pivot]] = earlier[1][[pivot, c]]
        full = np.array([0] * d, object)
        full[c + 1 :] = factor
        factors.append((c, full))

    def solve(b: np.ndarray) -> np.ndarray:
        x = b[order].copy()
        for c, factor in factors:
            x[c + 1 :] -= (factor[c + 1 :] * x[c]) >> FRACTION
        for c in range(d - 1, -1, -1):
            x[c] = ((x[c] - (int((a[c, c + 1 :] * x[c + 1 :]).sum()) >> FRACTION if c + 1 < d else 0)) << FRACTION) // a[c, c]
        return x

    def orthonormal(vectors: list[np.ndarray]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for v in vectors:
            v = (v << FRACTION) // max(1, max(abs(x) for x in v))
            for _ in range(2):
                for u in out:
                    v = v - ((u * (int((u * v).sum()) >> FRACTION)) >> FRACTION)
            out.append((v << FRACTION) // max(1, math.isqrt(int((v * v).sum()))))
        return out

    # Starts that no space is orthogonal to by plan: fractional parts of multiples of the golden section.
    vectors = orthonormal([np.array([((k * d + i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) - (1 << 63) for i in range(d)], object) for k in range(count)])
    for _ in range(2):
        vectors = orthonormal([solve(v) for v in vectors])
    out = []
    for v in vectors:
        exact = [float(x / one) if abs(x) < 1 << 1000 else float(x // one) for x in v]
        sign = -1.0 if max(exact, key=abs) < 0 else 1.0
        out.append([sign * x for x in exact])
    return out


def fit_whitening(vectors: DataFrame, vector_col: str = "embedding", *, components: int = 32, scale: int = 64) -> Whitening | None:
    """The model of all vectors of the commonest length (the least of ties), or None if there is none.

    Vectors that are null, empty or hold null or non-finite entries, and those of other lengths, take no part. scale * entry beyond 2^62 is taken as 2^62.
    Directions without variance aren't components, so there may be fewer than components.
    """
    spark = vectors.sparkSession
    sums = vectors.select(F.col(vector_col).cast("array<double>").alias("vector")).mapInArrow(_partial_sums(scale), _SUMS)
    counts = persisted(sums.groupBy("d", "i", "j", "k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")))
    best = counts.where((F.col("i") == -1) & (F.col("j") == -1)).orderBy(F.col("v").desc(), "d").first()
    if best is None:
        return None
    d, n = best["d"], int(best["v"])
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {d} dimensions; at most {MOST_DIMENSIONS} are whitened")
    products = [[0] * (d + 1) for _ in range(d + 1)]
    for r in counts.where(F.col("d") == d).collect():  # of the size of the dimension's square
        products[r["i"] + 1][r["j"] + 1] += int(r["v"]) << LIMB * r["k"]
    superseded(counts)
    s = products[0][1:]
    scatter = [[n * products[min(i, j) + 1][max(i, j) + 1] - s[i] * s[j] for j in range(d)] for i in range(d)]
    trace = sum(scatter[i][i] for i in range(d))
    common = math.gcd(*(x for row in scatter for x in row)) or 1
    reduced = [[x // common for x in row] for row in scatter]
    found, bits = greatest_roots(characteristic_polynomial(spark, reduced), components)

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id").to_pylist()
            yield pa.RecordBatch.from_pydict({"k": pa.array(ids, pa.int64()), "v": pa.array([null_vectors(reduced, *found[k][:2], bits, found[k][2]) for k in ids], pa.list_(pa.list_(pa.float64())))})

    bases = {r["k"]: r["v"] for r in _spread(spark, len(found), body, "k bigint, v array<array<double>>")} if found else {}
    roots, columns = [], []
    for k, (low, high, count) in enumerate(found):
        value = (low + high) * common / (1 << bits + 1)
        roots += [value] * count
        columns += bases[k]
    return Whitening(d, n, scale, s, roots[:components], np.array(columns[:components]).reshape(-1, d).T, trace)


_WHITE = "deviation decimal(38,0), whitened array<double>"


def _project(model: Whitening):
    # x - S/n is (n y - sum of y) / n, and e is the root over n^2.
    weights = model.components / np.sqrt(np.array(model.roots)) if model.roots else model.components
    sums = np.array(model.sums, object)
    k = len(model.roots)

    def centred(y: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        if model.n * max(1, int(np.abs(y).max())) < 1 << 60 and max(map(abs, model.sums)) < 1 << 60:
            z = y * model.n - sums.astype(np.int64)
            if y.shape[1] * float(np.abs(z).max()) ** 2 < 1 << 62:
                return z.astype(np.float64), pa.array((z * z).sum(axis=1)).cast(pa.decimal128(38, 0))
        z = y.astype(object) * model.n - sums
        return z.astype(np.float64), pa.array([str(x) for x in (z * z).sum(axis=1)]).cast(pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, y in _whole(b, model.scale):
                if y.shape[1] != model.dimension:
                    continue
                z, deviation = centred(y)
                white = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * k), pa.array((z @ weights).ravel()))
                yield pa.RecordBatch.from_pydict({"id": b.column("id").take(pa.array(rows)), "deviation": deviation, "whitened": white})

    return run


def whiten(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id_col, deviation decimal, whitened array<double>) of every vector that the model's fit would take part with; the others have no row.

    deviation is the exact sum over dimensions of (n x - S)^2 (an error beyond 38 digits). Repeated rows give repeated rows, a null identifier stays null,
    other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    out = rows.mapInArrow(_project(model), f"id {rows.schema['id'].dataType.simpleString()}, {_WHITE}")
    return out.withColumnRenamed("id", id_col)


def _moments(k: int, means: np.ndarray | None):
    """Partial sums of whitened, or of products of whitened less their means, per task: (i, v)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k if means is None else k * k)
        for b in batches:
            white = b.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            total += white.sum(axis=0) if means is None else ((white - means).T @ (white - means)).ravel()
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(total), dtype=np.int32)), "v": pa.array(total)})

    return run


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """The greatest absolute entry of the covariance of whitened, centred before multiplying, minus the identity; 0 without components."""
    k = len(model.roots)
    if k == 0:
        return 0.0

    def totals(means: np.ndarray | None) -> np.ndarray:
        found = whitened.select("whitened").mapInArrow(_moments(k, means), "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
        return np.array([r["v"] for r in found]) / model.n

    return float(np.abs(totals(totals(None)).reshape(k, k) - np.eye(k)).max())


def whitened_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, components: int = 32, scale: int = 64) -> DataFrame:
    """One row per vector and component: (id_col, component, n, deviation decimal, whitened, explained, identity_error).

    Rows and cases as in fit_whitening and whiten; no row if no direction varies, and none for an empty table.
    """
    spark = vectors.sparkSession
    model = fit_whitening(vectors, vector_col, components=components, scale=scale)
    if model is None or not model.roots:
        kind = vectors.schema[id_col].dataType.simpleString()
        return spark.createDataFrame([], f"`{id_col}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double")
    white = persisted(whiten(vectors, model, id_col, vector_col))
    error = identity_error(white, model)
    explained = F.array(*[F.lit(r / model.trace) for r in model.roots])
    return white.select(id_col, "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        id_col, (F.col("k") + 1).cast("int").alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(explained, F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
