"""Whitening against plain eigenvectors and exact integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from sparrowscope.llm import whitening
from sparrowscope.llm.whitening import fit, one_sided_jacobi, pivoted_cholesky, valid_vectors, whiten

ROWS = "vec_id bigint, embedding array<float>, id int, grid string, n string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*row, 1, "x", "y") for row in rows], ROWS).repartition(parts)


def check(rows, found, components=32):
    """Every result against plain loops and numpy's symmetric solver."""
    kept = [
        (i, [math.floor(64 * c) + 1_000_000 for c in v])
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    n, size = len(kept), len(kept[0][1])
    sums = [sum(x[d] for _, x in kept) for d in range(size)]
    centred = np.array([[(n * x[d] - sums[d]) / n for d in range(size)] for _, x in kept])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(found) == n * k
    by_component = {}
    for row in found:
        assert row["n"] == n and row["identity_error"] <= 1e-4
        by_component.setdefault(row["component"], {}).setdefault(row["vec_id"], []).append(row)
    assert sorted(by_component) == list(range(1, k + 1))
    deviations = {i: sum((n * x[d] - sums[d]) ** 2 for d in range(size)) for i, x in kept}
    gap = lambda c: min(abs(values[c] - v) for j, v in enumerate(values) if j != c) / values[0]
    for c in range(k):
        rows_of = by_component[c + 1]
        assert all(r["deviation"] == deviations[i] for i, same in rows_of.items() for r in same)
        assert rows_of[kept[0][0]][0]["explained"] == pytest.approx(values[c] / np.trace(covariance), rel=1e-9)
        if size > 1 and gap(c) < 1e-6:
            continue  # any basis of equal eigenvalues will do
        expected = centred @ vectors[:, c] / math.sqrt(values[c])
        own = np.array([rows_of[i][0]["whitened"] for i, _ in kept])
        sign = 1 if own @ expected > 0 else -1
        np.testing.assert_allclose(own, sign * expected, rtol=0, atol=1e-7)


def test_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    random = np.random.default_rng(3)
    mix = random.normal(size=(7, 7))
    rows = [(i, [float(v) for v in np.float32(mix @ random.normal(size=7) + 3)]) for i in range(60)]
    rows += [(100, None), (101, [1.0, None] + [0.0] * 5), (102, [math.inf] + [0.0] * 6), (103, [math.nan] * 7), (104, [])]
    rows += [rows[0], rows[0]]
    check(rows, whiten(frame(spark, rows, 5)).collect())
    check(rows, whiten(frame(spark, rows), components=3).collect(), 3)


def test_dependent_and_constant_dimensions(spark):
    random = np.random.default_rng(4)
    base = random.integers(-50, 50, size=(40, 2)) / 8
    rows = [(i, [float(a), float(b), float(a + b), 1e4, float(a)]) for i, (a, b) in enumerate(base)]
    found = whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in found} == {1, 2}
    check(rows, found)


def test_fewer_rows_than_dimensions(spark):
    random = np.random.default_rng(5)
    rows = [(i, [float(np.float32(v)) for v in random.normal(size=40)]) for i in range(6)]
    found = whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4, 5}
    check(rows, found)


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None), (2, [])], [(1, [2.0, 3.0])], [(1, [2.0, 3.0])] * 4):
        empty = whiten(frame(spark, rows))
        assert empty.collect() == []
        assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_other_lengths_drop_out(spark):
    rows = [(i, [float(i % 3), float(i % 5)]) for i in range(20)]
    found = whiten(frame(spark, rows + [(90, [1.0]), (91, [1.0, 2.0, 3.0]), (None, [1.0, 4.0])])).collect()
    assert {r["vec_id"] for r in found} == {*range(20), None}
    assert found[0]["n"] == 21


def test_large_offsets_and_long_limit(spark):
    """Centring before multiplying: a variance of one step beside a mean of millions; and a
    deviation beyond a long is null."""
    rows = [(i, [float(1_000_000 + i % 2), float(i % 7)]) for i in range(50)]
    check(rows, whiten(frame(spark, rows)).collect())
    huge = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 5.0])]
    found = whiten(frame(spark, huge)).collect()
    assert all(r["deviation"] is None for r in found if r["vec_id"] != 3)
    far = whiten(frame(spark, [*rows, (99, [1e30, 0.0])])).collect()
    assert {r["vec_id"] for r in far} == set(range(50))


def test_factor_and_rotations():
    random = np.random.default_rng(6)
    for size, rank in ((1, 1), (2, 2), (9, 9), (12, 5), (33, 33)):
        half = random.normal(size=(size, rank)) * 10.0 ** random.integers(-3, 3, size=rank)
        matrix = half @ half.T
        factor = pivoted_cholesky(matrix)
        assert factor.shape[0] == size and factor.shape[1] <= rank
        np.testing.assert_allclose(factor @ factor.T, matrix, atol=1e-10 * np.abs(matrix).max())
        # Triangular with the pivots as order of the rows: column k is zero at earlier pivots.
        pivots = [int(np.argmax(np.abs(factor[:, k]))) for k in range(factor.shape[1])]
        for k in range(factor.shape[1]):
            assert not factor[pivots[:k], k].any()
        values, vectors = one_sided_jacobi(factor)
        np.testing.assert_allclose(values, np.linalg.eigvalsh(matrix)[::-1][: len(values)], rtol=1e-8, atol=1e-10 * values[0])
        np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-9)
    assert pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_layout_does_not_matter(spark):
    random = np.random.default_rng(7)
    rows = [(i, [float(np.float32(v)) for v in random.normal(size=5)]) for i in range(50)]
    models = [fit(valid_vectors(frame(spark, rows, parts))) for parts in (1, 4, 9)]
    assert all((m.components == models[0].components).all() for m in models)
