"""Inertia and eigenpairs against numpy, the whole operator against exact arithmetic in one process."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import queries, whitening
from ledgerline.llm.shared import table

SCHEMA = "vec_id long, embedding array<double>"


def covariance(size, seed, values=None):
    draw = np.random.default_rng(seed)
    basis = np.linalg.qr(draw.standard_normal((size, size)))[0]
    values = draw.random(size) ** 4 * 1000 if values is None else np.array(values, float)
    return (basis * values) @ basis.T


def test_inertia_counts_eigenvalues():
    for seed in range(6):
        matrix = covariance(20, seed) - 3 * np.eye(20)
        matrix = (matrix + matrix.T) / 2
        values = np.linalg.eigvalsh(matrix)
        for shift in [-5.0, 0.0, 1.0, float(values[7]) + 1e-9, float(values[7]) - 1e-9, 2000.0]:
            assert whitening.inertia(matrix, shift) == (values > shift).sum()
    assert whitening.inertia(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1
    assert whitening.inertia(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("values", [
    None, [5, 5, 5, 1, 1, 1], [1e9, 1, 1 + 1e-9, 1e-3, 0, 0], [3] * 6, [1, 1 - 1e-13, 1 - 2e-13, 0.5, 0.5, 0.1], [7, 0, 0, 0],
])
def test_leading_eigenpairs(values):
    matrix = covariance(len(values) if values else 64, 3, values)
    matrix = (matrix + matrix.T) / 2
    want = np.linalg.eigvalsh(matrix)[::-1]
    found = whitening.leading(matrix, 16)
    rank = int((want > 8 * len(matrix) * whitening.EPS * np.abs(matrix).sum(axis=1).max()).sum())
    assert len(found.values) == min(16, rank)
    scale = want[0]
    assert np.allclose(found.values, want[: len(found.values)], rtol=1e-10, atol=1e-13 * scale)
    assert (np.diff(found.values) <= 0).all()
    assert np.abs(found.vectors.T @ found.vectors - np.eye(len(found.values))).max() < 1e-9
    assert np.abs(matrix @ found.vectors - found.vectors * found.values).max() < 1e-11 * scale


def brute(rows):
    """{vec_id: [(n, deviation, |whitened|, explained)]} with Python integers and numpy's eigenvectors."""
    kept = [(key, [math.floor(64 * c) + 1_000_000 for c in v]) for key, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = defaultdict(list)
    for size in {len(x) for _, x in kept}:
        own = [(key, x) for key, x in kept if len(x) == size]
        distinct = sorted({tuple(x) for _, x in own})
        n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
        y = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in distinct]).reshape(n, size)
        v = y.T @ y / n
        values, vectors = np.linalg.eigh(v) if size else (np.zeros(0), np.zeros((0, 0)))
        order = [i for i in np.argsort(-values)[:16] if values[i] > 1e-9 * max(1.0, values.max())]
        for key, x in own:
            exact = [n * c - s for c, s in zip(x, sums)]
            centred = np.array([e / n for e in exact])
            for number, i in enumerate(order, 1):
                out[key].append((
                    number, n, sum(e * e for e in exact), abs(centred @ vectors[:, i]) / math.sqrt(values[i]),
                    values[i] / np.trace(v),
                ))
    return out


def agrees(result, want):
    found = defaultdict(list)
    signs = defaultdict(set)
    for r in result.collect():
        found[r["vec_id"]].append((r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]))
        signs[r["component"]].add(r["identity_error"])
        assert r["identity_error"] <= 1e-9
    assert set(found) == {key for key, rows in want.items() if rows}
    for key, rows in found.items():
        for a, b in zip(sorted(rows), sorted(want[key]), strict=True):
            assert a[:3] == b[:3]
            assert a[3] == pytest.approx(b[3], rel=1e-7, abs=1e-7) and a[4] == pytest.approx(b[4], rel=1e-9)


def test_registered_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, folder, "embeddings").collect()]
    result = queries.op13_spectrum_slicing(spark, folder)
    assert result.dtypes[1:] == [
        ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"),
        ("identity_error", "double")]
    agrees(result, brute(rows))
    # one sign for all rows: the whitened list itself has the identity as covariance
    wide = {r["vec_id"]: r["w"] for r in result.groupBy("vec_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("component", "whitened"))), lambda s: s["whitened"]).alias("w")).collect()}
    distinct = {tuple(math.floor(64 * c) for c in v): wide[key] for key, v in rows}
    y = np.array(list(distinct.values()))
    y -= y.mean(axis=0)
    assert np.abs(y.T @ y / len(y) - np.eye(16)).max() < 1e-9


def test_awkward_rows(spark):
    draw = np.random.default_rng(2)
    vectors = [draw.standard_normal(5).tolist() for _ in range(40)]
    rows = list(enumerate(vectors)) + [
        (100, vectors[0]), (100, vectors[0]), (None, vectors[1]), (101, None), (102, []), (103, [1.0, None, 2.0, 3.0, 4.0]),
        (104, [float("nan")] * 5), (105, [float("inf")] * 5), (106, [1.0, 2.0]), (107, [3.0, 7.0]), (108, [3.0]),
        (109, [x + 1e-9 for x in vectors[2]]),
    ]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], SCHEMA + ", x int").repartition(4)
    agrees(whitening.whiten(df), brute(rows))


def test_entries_of_any_size(spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [5e11, -3.0]), (4, [0.0, 9.0])]
    result = {(r["vec_id"], r["component"]): r for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {key for key, _ in result} == {1, 2, 3, 4}
    assert all(math.isfinite(r["whitened"]) for r in result.values())
    assert result[1, 1]["deviation"] is None  # about 2^124
    near = [(1, [2e3, 0.0]), (2, [-2e3, 1.0]), (3, [1e3, -3.0])]
    agrees(whitening.whiten(spark.createDataFrame(near, SCHEMA)), brute(near))


def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(rows(SCHEMA)).collect() == []
    assert whitening.whiten(rows(SCHEMA, (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None))).collect() == []
