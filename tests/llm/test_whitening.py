"""Exact steps of the whitening by exact identities; the query against a plain eigen decomposition."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from benchloom.llm import whitening
from benchloom.llm.queries import QUERIES


def random_scatter(n, size, seed, low=-900, high=900):
    rng = random.Random(seed)
    x = np.array([[rng.randint(low, high) for _ in range(size)] for _ in range(n)], dtype=object)
    return x.T @ x


@pytest.mark.parametrize(("size", "n"), [(1, 3), (2, 5), (5, 3), (12, 40)])
def test_polynomial_is_exact(spark, size, n):
    m = random_scatter(n, size, size)
    poly = whitening.characteristic_polynomial(spark, m)
    assert poly[-1] == 1 and poly[-2] == -int(np.trace(m))
    value = np.zeros((size, size), dtype=object)
    for c in reversed(poly):  # a matrix is a root of its characteristic polynomial
        value = value @ m + c * np.eye(size, dtype=int).astype(object)
    assert not value.any()


def test_polynomial_modulo_needs_row_exchanges():
    m = np.array([[0, 0, 0, 2], [0, 0, 3, 0], [0, 3, 0, 0], [2, 0, 0, 0]], dtype=np.int64)
    assert whitening.polynomial_mod(m % 101, 101) == [36, 0, 101 - 13, 0, 1]  # (t^2 - 4)(t^2 - 9)


def test_primes():
    assert whitening.primes_below(30, 4) == [29, 23, 19, 17]
    assert whitening.primes_below(1 << 31, 1) == [2147483647]


def poly_of(roots):
    poly = [Fraction(1)]
    for r in roots:
        poly = [a - r * b for a, b in zip([Fraction(0), *poly], [*poly, Fraction(0)], strict=True)]
    return poly


def test_roots_with_multiplicity():
    roots = [900, 900, 37, 36, 5, 5, 5, 1, 0, 0]
    poly = [int(c) for c in poly_of(roots)]
    found = whitening.largest_roots(poly, 8)
    assert [(round(float(r), 9), m) for r, m in found] == [(900, 2), (37, 1), (36, 1), (5, 3), (1, 1)]
    assert all(abs(r - round(r)) < Fraction(1, 1 << 150) for r, _ in found)
    assert sum(m for _, m in whitening.largest_roots(poly, 2)) == 2
    close = [int(c * 10**80) for c in poly_of([Fraction(7), 7 + Fraction(1, 10**35), Fraction(3)])]
    assert [m for _, m in whitening.largest_roots([c for c in close], 3)] in ([1, 1, 1], [2, 1])


def test_components_of_a_multiple_root_are_orthonormal():
    q = np.array([[1, 1, 1, 1], [1, -1, 1, -1], [1, 1, -1, -1], [1, -1, -1, 1]], dtype=object)
    m = q.T @ np.diag(np.array([5, 5, 5, 2], dtype=object)) @ q  # eigenvalues 20, 20, 20, 8
    v = whitening.null_vectors(m, Fraction(20), 3)
    assert np.abs(v.T @ v - np.eye(3)).max() < 1e-14
    assert np.abs(m.astype(float) @ v - 20 * v).max() < 1e-12


def test_products_of_large_numbers_are_exact():
    rng = random.Random(4)
    x = [[rng.randint(-(2**52), 2**52) for _ in range(3)] for _ in range(50)]
    own = np.array(x, dtype=object)
    assert (whitening.exact_products(np.array(x, dtype=float)) == own.T @ own).all()


def vectors(n, size, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(size, size)) * np.linspace(2, 0.05, size)
    return (rng.normal(size=(n, size)) @ base + 0.3).astype(np.float32)


def check(rows, got, components=8):
    x = np.floor(1024 * np.array([v for _, v in rows], dtype=np.float64)) + 100000
    n = len(x)
    s = [int(v) for v in x.sum(axis=0)]
    centred = x - x.mean(axis=0)
    cov = centred.T @ centred / n
    values, own = np.linalg.eigh(cov)
    order = np.argsort(-values)[: min(components, len(cov))]
    by = {}
    for r in got:
        by.setdefault(r.component, {})[r.vec_id] = r
    assert sorted(by) == list(range(1, len(order) + 1))
    for c, k in enumerate(order, 1):
        z = centred @ own[:, k] / np.sqrt(values[k])
        found = np.array([by[c][i].whitened for i, _ in rows])
        assert np.allclose(found, z, atol=1e-8) or np.allclose(found, -z, atol=1e-8)
        r = by[c][rows[0][0]]
        assert r.n == n and abs(r.explained - values[k] / np.trace(cov)) < 1e-9 and r.identity_error < 1e-9
    for (i, _), own_x in zip(rows, x, strict=True):
        assert by[1][i].deviation == sum((n * int(v) - t) ** 2 for v, t in zip(own_x, s, strict=True))


def test_query_against_plain_numbers(spark, tmp_path):
    rows = [(k, v.tolist()) for k, v in enumerate(vectors(400, 20, 1))]
    odd = [(900, None), (901, [1.0, None] + [0.0] * 18), (902, [float("nan")] + [0.0] * 19), (903, [float("-inf")] * 20), (904, []), (905, [1.0, 2.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("n", F.lit("x"))
    df.repartition(5).write.parquet(str(tmp_path / "embeddings.parquet"))
    out = QUERIES["op13_whitening"](spark, str(tmp_path))
    assert dict(out.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double",
    }
    check(rows, out.collect())


def test_few_dimensions_and_ties(spark):
    rows = [(k, [float(a), float(b)]) for k, (a, b) in enumerate([(1, 0), (-1, 0), (0, 1), (0, -1)] * 3)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 24 and {r.component for r in got} == {1, 2} and {r.explained for r in got} == {0.5}
    assert max(r.identity_error for r in got) < 1e-12
    assert {r.deviation for r in got} == {1024**2 * 144}


def test_nothing_to_whiten(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0])]):
        out = whitening.whiten(spark.createDataFrame(rows, schema))
        assert out.collect() == [] and "whitened" in out.columns
    line = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (None, [3.0, 6.0])], schema)).collect()
    assert [r.component for r in line] == [1, 1] and sorted(abs(r.whitened) for r in line) == pytest.approx([1, 1])


def test_deviations_beyond_a_long(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [5.0, 7.0])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("component = 1").collect()
    x = {i: [int(np.floor(1024 * c)) + 100000 for c in v] for i, v in rows}
    s = [sum(v[k] for v in x.values()) for k in (0, 1)]
    for r in got:
        exact = sum((3 * v - t) ** 2 for v, t in zip(x[r.vec_id], s, strict=True))
        assert r.deviation_digits == str(exact) and r.deviation == (exact if exact < 2**63 else None)
