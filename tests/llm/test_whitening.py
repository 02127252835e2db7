"""Whitening against numpy's own decomposition and exact arithmetic on small matrices."""

from fractions import Fraction

import numpy as np
import pytest

from barloom.llm import queries
from barloom.llm import whitening as w

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int, component string"


def faddeev(matrix):
    """Coefficients of det(t - matrix), constant first, by Faddeev and LeVerrier over fractions."""
    d = len(matrix)
    out, m = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][x] * m[x][j] for x in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        out.append(-sum(sum(matrix[i][x] * m[x][i] for x in range(d)) for i in range(d)) / k)
    return [int(x) for x in reversed(out)]


def gram(rows):
    return [[sum(r[i] * r[j] for r in rows) for j in range(len(rows[0]))] for i in range(len(rows[0]))]


@pytest.mark.parametrize("rows", [
    [[3, -1, 7], [2, 2, 2], [0, 5, -4]],
    [[10**12, 3, 0, 1], [0, 10**12, 5, 0], [7, 0, 10**12, 2], [1, 1, 1, 1]],
    [[1, 2, 3, 4], [2, 4, 6, 8]],
    [[0, 0], [0, 0]],
    [[5]],
    [[2, 0, 0], [0, 2, 0], [0, 0, 2]],
    [[0, 0, 1, 0], [0, 0, 0, 1], [1, 0, 0, 3], [0, 1, 3, 0]],
])
def test_polynomial_is_exact(spark, rows):
    matrix = gram(rows)
    assert w.characteristic_polynomial(spark, matrix) == faddeev(matrix)


def test_roots_with_their_multiplicity():
    poly = np.array([1], object)
    for root in (5, 5, 5, 9, 0, 0, 2):
        poly = np.convolve(poly, np.array([-root, 1], object))
    found, bits = w.greatest_roots([int(x) for x in poly], 7)
    assert [(round(high / 2**bits, 9), count) for _, high, count in found] == [(9, 1), (5, 3), (2, 1)]
    assert all(low < root << bits <= high for (low, high, _), root in zip(found, (9, 5, 2)))
    assert [w.roots_above([int(x) for x in poly], at) for at in (-1, 0, 1, 2, 4, 5, 8, 9)] == [7, 5, 5, 4, 4, 1, 1, 0]


def test_close_roots_keep_apart():
    # Roots 10^9 and 10^9 + 1, rotated: apart by one part in 10^9.
    m = [[10**9, 0, 0], [0, 10**9 + 1, 0], [0, 0, 3]]
    found, bits = w.greatest_roots(faddeev(m), 3)
    assert [c for _, _, c in found] == [1, 1, 1]
    vectors = [w.null_vectors(m, *f[:2], bits, 1)[0] for f in found]
    assert np.allclose(np.abs(vectors), [[0, 1, 0], [1, 0, 0], [0, 0, 1]], atol=1e-15)


def reference(vectors):
    x = np.floor(64 * np.array(vectors, np.float64))
    c = x - x.mean(axis=0)
    e, u = np.linalg.eigh(c.T @ c / len(x))
    return x, c, e[::-1], u[:, ::-1]


def test_query_equals_numpy(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = [r["vec_id"] for r in rows]
    x, c, e, u = reference([r["embedding"] for r in rows])
    got = queries.op13_whitening(spark, SF).toPandas()
    assert len(got) == 32 * len(rows) and set(got["n"]) == {len(rows)} and got["identity_error"].max() < 1e-12 and got["identity_error"].nunique() == 1
    xi = x.astype(np.int64)
    deviation = dict(zip(ids, ((len(xi) * xi - xi.sum(axis=0)) ** 2).sum(axis=1).tolist()))
    assert dict(zip(got["vec_id"], got["deviation"])) == deviation
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    expected = c @ u[:, :32] / np.sqrt(e[:32])
    sign = np.sign((wide * expected).sum(axis=0))
    assert np.allclose(wide, expected * sign, atol=1e-7)
    assert np.allclose(got.groupby("component")["explained"].first(), e[:32] / e.sum(), rtol=1e-9)


def test_awkward_rows(spark):
    rng = np.random.default_rng(5)
    fine = [(k, [float(v) for v in rng.normal(size=3)], 1, "x") for k in range(40)]
    bad = [(100, None, 1, "x"), (101, [], 1, "x"), (102, [1.0, None, 2.0], 1, "x"), (103, [1.0, float("nan"), 2.0], 1, "x"), (104, [float("inf"), 0.0, 0.0], 1, "x"), (105, [1.0, 2.0], 1, "x")]
    again = [fine[3], (None, fine[4][1], None, None)]
    got = w.whitened_components(spark.createDataFrame(fine + bad + again, SCHEMA)).collect()
    kept = fine + again
    assert len(got) == 3 * len(kept) and {r["n"] for r in got} == {len(kept)}
    assert {r["vec_id"] for r in got} == {r[0] for r in kept}
    _, c, e, u = reference([r[1] for r in kept])
    white = np.abs(c @ u / np.sqrt(e))
    assert np.allclose(sorted(abs(r["whitened"]) for r in got if r["vec_id"] == 7), sorted(white[7]), atol=1e-9)
    assert len([r for r in got if r["vec_id"] == 3]) == 6


def test_large_entries_are_exact(spark):
    values = [[2.0**50, 1.0], [-(2.0**49), 3.0], [5.0, 2.0**51], [1e300, -1e300]]
    got = w.whitened_components(spark.createDataFrame([(k, v, 1, "x") for k, v in enumerate(values[:3])], "vec_id bigint, embedding array<double>, label int, component string")).collect()
    x = [[int(64 * a) for a in v] for v in values[:3]]
    s = [sum(c) for c in zip(*x)]
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == {k: sum((3 * a - b) ** 2 for a, b in zip(v, s)) for k, v in enumerate(x)}
    model = w.fit_whitening(spark.createDataFrame([(v,) for v in values], "embedding array<double>"))  # saturates, but holds
    assert model.n == 4 and len(model.roots) == 2


def test_flat_and_repeated_directions(spark):
    make = lambda rows: w.whitened_components(spark.createDataFrame([(k, [float(x) for x in v], 1, "x") for k, v in enumerate(rows)], SCHEMA))
    assert make([]).count() == 0 and make([]).columns == make([[1, 2], [2, 1]]).columns
    assert make([[1, 2]]).count() == 0 and make([[1, 2]] * 5).count() == 0  # nothing varies
    flat = make([[1, 0, 9], [2, 0, 9], [4, 0, 9]]).collect()  # one direction varies
    assert {(r["component"], r["explained"]) for r in flat} == {(1, 1.0)} and flat[0]["identity_error"] < 1e-12
    ball = make([[1, 0, 0], [-1, 0, 0], [0, 1, 0], [0, -1, 0], [0, 0, 1], [0, 0, -1]]).collect()  # one root three times
    assert len(ball) == 18 and ball[0]["identity_error"] < 1e-12 and {round(r["explained"], 12) for r in ball} == {round(1 / 3, 12)}
