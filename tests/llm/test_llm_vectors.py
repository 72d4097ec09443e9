"""Embedding whitening against plain linear algebra."""

import numpy as np
import pyarrow.parquet as pq
import pytest

from conftest import DATA
from starhouse.llm import queries, whitening

KIND = "vec_id long, embedding array<float>, label int"


def _plain(vectors):
    """(exact deviations, eigenvalues falling, eigenvectors, centred) of the fixed-point vectors."""
    x = [[int(np.floor(1024 * float(c))) + 100_000 for c in v] for v in vectors]
    n, totals = len(x), [sum(c) for c in zip(*x, strict=True)]
    gaps = [[n * c - t for c, t in zip(row, totals, strict=True)] for row in x]
    centred = np.array(gaps, float) / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    return [sum(g * g for g in row) for row in gaps], values[::-1], found[:, ::-1], centred


def _check(rows, vectors, ids, loose=1e-9):
    deviations, values, found, centred = _plain(vectors)
    by_key = {(r["vec_id"], r["component"]): r for r in rows}
    most = max(r["component"] for r in rows)
    assert len(rows) == len(by_key) == most * len(vectors)
    want = centred @ found[:, :most] / np.sqrt(values[:most])
    for c in range(most):
        got = np.array([by_key[i, c + 1]["whitened"] for i in ids])
        want[:, c] *= np.sign(got @ want[:, c])
        assert np.abs(got - want[:, c]).max() < loose
        assert by_key[ids[0], c + 1]["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
    assert [by_key[i, 1]["deviation"] for i in ids] == deviations
    assert {r["n"] for r in rows} == {len(vectors)} and rows[0]["identity_error"] < 1e-8


def test_op11_equals_plain_linear_algebra(spark):
    table = pq.read_table(f"{DATA}/sf0.001/embeddings.parquet").to_pylist()
    rows = queries.op11_embedding_whitening(spark, f"{DATA}/sf0.001").collect()
    assert max(r["component"] for r in rows) == 8
    _check(rows, [r["embedding"] for r in table], [r["vec_id"] for r in table])


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    good = [rng.normal(size=3).astype(np.float32).tolist() for _ in range(40)]
    good[7] = good[8] = good[9]  # repeated vectors
    rows = [(i, v, 0) for i, v in enumerate(good)]
    rows += [(100, None, 0), (101, [1.0, None, 2.0], 0), (102, [1.0, float("nan"), 2.0], 0),
             (103, [float("inf"), 0.0, 0.0], 0), (104, [1.0, 2.0], 0), (105, [], 0), (106, [1e30, 0.0, 0.0], 0)]
    docs = spark.createDataFrame(rows, KIND).selectExpr("*", "'x' AS component", "'y' AS id", "1 AS n")
    found = whitening.whiten(docs.repartition(5)).collect()
    assert {r["component"] for r in found} == {1, 2, 3}
    _check(found, good, list(range(40)))
    empty = whitening.whiten(docs.filter("vec_id >= 100 AND vec_id <> 104 AND vec_id <> 105"))
    assert empty.collect() == [] and "whitened" in empty.columns
    assert whitening.whiten(docs.limit(0)).count() == 0
    assert whitening.whiten(docs.filter("vec_id = 3")).count() == 0  # one row has no variance


def test_null_and_repeated_ids_count(spark):
    rows = [(None, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (1, [0.0, 1.0], 0), (2, [3.0, -1.0], 0)]
    found = whitening.whiten(spark.createDataFrame(rows, KIND)).collect()
    assert len(found) == 8 and {r["n"] for r in found} == {4}


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(6)
    vectors = (rng.integers(-2**20, 2**20, size=(30, 2)) * 2.0**18).astype(np.float32).tolist()
    found = whitening.whiten(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], KIND))
    _check(found.collect(), vectors, list(range(30)))


@pytest.mark.parametrize("seed, shape", [(0, (50, 12)), (1, (12, 12)), (2, (5, 12)), (3, (300, 40))])
def test_values_and_vectors(seed, shape):
    rng = np.random.default_rng(seed)
    r = np.linalg.qr(rng.normal(size=shape) * 10.0 ** rng.integers(-3, 4, shape[1]), mode="r")
    r = np.vstack([r, np.zeros((shape[1] - len(r), shape[1]))])
    want = np.linalg.svd(r, compute_uv=False) ** 2
    values, vectors = whitening.directions(r, 8)
    assert np.allclose(values, want[:len(values)], rtol=1e-12) and len(values) == min(8, shape[0])
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-10
    left = r.T @ (r @ vectors) - vectors * values
    assert np.abs(left).max() < 1e-12 * want[0] * shape[1]


@pytest.mark.parametrize("spectrum", [
    [5.0] * 6 + [1.0] * 6, [5.0, 5.0, 5.0 - 1e-9, 5.0 - 1e-13, 3.0, 1e-6, 1e-6, 0.0, 0.0, 0.0, 0.0, 0.0],
    [1.0] * 12, [3.0] + [0.0] * 11, [0.0] * 12,
])
def test_equal_and_zero_values(spectrum):
    rng = np.random.default_rng(9)
    turn, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    r = np.linalg.qr(np.diag(spectrum) @ turn, mode="r")
    values, vectors = whitening.directions(r, 8)
    want = np.sort(np.array(spectrum) ** 2)[::-1][:8]
    want = want[want > 0]
    assert np.allclose(values, want, rtol=1e-6) and len(values) == len(want)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max(initial=0) < 1e-9
    if len(values):
        assert np.abs(r.T @ (r @ vectors) - vectors * values).max() < 1e-10 * want[0]


def test_dqds_is_accurate_for_small_values():
    a, b = np.array([1.0, 1e-3, 1e-6, 1e-9]), np.array([1e-1, 1e-4, 1e-7])
    product = 1.0
    for value in whitening.dqds(a, b):
        product *= value
    assert product == pytest.approx(float(np.prod(a)) ** 2, rel=1e-13)


def test_triangles_of_many_tasks_are_combined(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(400, 5)).astype(np.float32).tolist()
    docs = spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], KIND).repartition(40)
    _check(whitening.whiten(docs).collect(), vectors, list(range(400)))
