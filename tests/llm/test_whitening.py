"""Whitening against a library's eigenvectors and exact arithmetic."""

from __future__ import annotations

import math

import numpy as np
import pytest

from pulsegrid.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("n", [1, 2, 3, 10, 64, 150])
def test_eigenvectors_of_random_matrices(n):
    rng = np.random.default_rng(n)
    for spread in (1.0, 1e-3, 6.0):
        a = rng.normal(size=(n + 5, n)) * np.logspace(0, spread, n)
        v = a.T @ a
        values, vectors = whitening.leading(v, 32)
        want = np.linalg.eigvalsh(v)[::-1][: min(n, 32)]
        scale = np.abs(want).max()
        assert np.abs(values - want).max() <= 1e-13 * scale
        assert np.abs(v @ vectors - vectors * values).max() <= 1e-12 * scale
        assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-11


def test_clusters_and_split_matrices():
    rng = np.random.default_rng(0)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    close = np.r_[np.full(10, 5.0), 5 + np.arange(10) * 1e-13, np.linspace(0, 1, 20)]
    blocks = np.kron(np.eye(8), np.array([[2.0, 1, 0, 0, 0], [1, 2, 1, 0, 0], [0, 1, 2, 0, 0], [0, 0, 0, 3, 0], [0, 0, 0, 0, 3]]))
    wilkinson = np.diag(np.abs(np.arange(-20.0, 21))) + np.eye(41, k=1) + np.eye(41, k=-1)
    for v in (turn * close @ turn.T, blocks, wilkinson, np.eye(40), np.zeros((40, 40)), np.diag(np.arange(40.0))):
        values, vectors = whitening.leading((v + v.T) / 2, 32)
        assert np.abs(values - np.linalg.eigvalsh(v)[::-1][:32]).max() <= 1e-12
        assert np.abs(v @ vectors - vectors * values).max() <= 1e-11
        assert np.abs(vectors.T @ vectors - np.eye(32)).max() <= 1e-11


def plainly(rows):
    """Mean, covariance and exact deviations of lists of whole numbers."""
    n, sums = len(rows), [sum(c) for c in zip(*rows)]
    apart = [sum((n * x - s) ** 2 for x, s in zip(row, sums)) for row in rows]
    centred = np.array([[x - s / n for x, s in zip(row, sums)] for row in rows])
    return centred, centred.T @ centred / n, apart


def whole(vector):
    return [math.floor(64 * float(c)) + 1_000_000 for c in vector]


def check(got, vectors, components=32):
    centred, v, apart = plainly([whole(x) for _, x in vectors])
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    held = int((values > values[0] * 1e-11).sum())
    assert len(got) == held * len(vectors)
    order = sorted(range(len(vectors)), key=lambda i: (vectors[i][0] is None, vectors[i][0] or 0, apart[i]))
    got = sorted(got, key=lambda r: (r["component"], r["vec_id"] is None, r["vec_id"] or 0, r["deviation"]))
    white = np.array([r["whitened"] for r in got]).reshape(held, len(vectors)).T
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in got] == [
        (vectors[i][0], k + 1, len(vectors), apart[i]) for k in range(held) for i in order
    ]
    explained = [r["explained"] for r in got[:: len(vectors)]]
    assert np.allclose(explained, values[:held] / np.trace(v), rtol=1e-9)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] <= 1e-9
    want = (centred @ basis / np.sqrt(np.where(values > 0, values, 1)))[order][:, :held]
    for k in range(held):  # either sign, the same for all rows
        assert min(np.abs(white[:, k] - want[:, k]).max(), np.abs(white[:, k] + want[:, k]).max()) <= 1e-7


def test_query_against_plain_arithmetic(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    vectors = [(r["vec_id"], r["embedding"]) for r in rows if r["embedding"] is not None]
    vectors = [(i, x) for i, x in vectors if all(c is not None and math.isfinite(c) for c in x)]
    check(queries.op11_whitening(spark, SF_DIR).collect(), vectors)


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    fine = [((1 << 60) + i, rng.normal(size=5).astype(np.float32).tolist()) for i in range(20)]
    fine += [fine[3], (None, [0.0] * 5), (None, fine[4][1]), (7, [30.0, -2.5, 0.0, 1e-30, -1e-30])]
    nan, inf = float("nan"), float("inf")
    odd = [(1, None), (2, []), (3, [nan] + [0.0] * 4), (4, [inf] + [0.0] * 4), (5, [None] + [0.0] * 4), (6, [1.0]), (8, [3e38] * 5)]
    schema = "vec_id long, embedding array<float>, component string, vector map<string,int>"
    frame = lambda rows: spark.createDataFrame([(*r, "x", {"a": 1}) for r in rows], schema)
    check(whitening.whiten(frame(fine + odd).repartition(5)).collect(), fine)
    check(whitening.whiten(frame(fine), components=2).collect(), fine, 2)
    for none in ([], odd[:5], fine[:1], [fine[0]] * 4):
        assert whitening.whiten(frame(none)).count() == 0
    flat = [(i, [float(i), 2.0 * i, 1.0, 0.0]) for i in range(9)]  # one direction only
    assert {r["component"] for r in whitening.whiten(frame(flat)).collect()} == {1}


def test_large_numbers(spark):
    vectors = [(i, [float(i) * 1e6, float(i * i), -1e9]) for i in range(50)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    apart = plainly([whole(x) for _, x in vectors])[2]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(frame).collect()}
    assert got == {i: (a if a < 1 << 63 else None) for (i, _), a in zip(vectors, apart)}
