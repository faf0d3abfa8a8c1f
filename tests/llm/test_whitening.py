"""Whitening against NumPy's eigenvalues and whole-number arithmetic."""

import math
import os

import numpy as np
import pytest

from zerotally.llm import whitening
from zerotally.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors):
    """n, deviations, covariance and trace in Python integers and fractions of them."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, total = len(x), [sum(c) for c in zip(*x)]
    off = [[n * a - s for a, s in zip(row, total)] for row in x]
    cov = [[sum(r[i] * r[j] for r in off) for j in range(len(total))] for i in range(len(total))]
    return n, [sum(a * a for a in r) for r in off], np.array([[float(v) / n ** 3 for v in row] for row in cov]), off


def check(rows, vectors, components=32):
    n, deviation, cov, off = brute(list(vectors.values()))
    values, _ = np.linalg.eigh(cov)
    values = values[::-1]
    rank = int((values > 1e-13 * values[0]).sum())
    k = min(components, rank)
    got = {}
    for r in rows:
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(got) == set(vectors)
    w = np.empty((n, k))
    for i, key in enumerate(vectors):
        assert sorted(got[key]) == list(range(1, k + 1))
        for c, r in got[key].items():
            assert r["n"] == n and int(r["deviation"]) == deviation[i]
            assert abs(r["explained"] - values[c - 1] / np.trace(cov)) < 1e-9 and 0 <= r["identity_error"] < 1e-6
            w[i, c - 1] = r["whitened"]
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-7
    # each component is a unit eigenvector: projecting the covariance gives e_k back
    centred = np.array(off, float) / n
    for c in range(k):
        v = np.linalg.lstsq(centred, w[:, c] * math.sqrt(values[c]), rcond=None)[0]
        assert abs(np.linalg.norm(v) - 1) < 1e-6 and np.abs(cov @ v - values[c] * v).max() < 1e-6 * values[0]


def _frame(spark, vectors, more=()):
    return spark.createDataFrame([*((i, [float(x) for x in v]) for i, v in vectors.items()), *more], SCHEMA)


def test_against_numpy(spark):
    rng = np.random.default_rng(1)
    vectors = dict(enumerate((rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12))).astype(np.float32)))
    bad = [(1000, None), (1001, [None] * 12), (1002, [float("nan")] * 12), (1003, [float("inf")] + [0.0] * 11), (1004, [1.0]), (1005, [])]
    frame = _frame(spark, vectors, bad).withColumn("n", __import__("pyspark").sql.functions.lit("x")).repartition(5)
    check(whitening.whiten(frame).collect(), vectors)
    check(whitening.whiten(frame, components=3).collect(), vectors, 3)


def test_rank_and_scales(spark):
    rng = np.random.default_rng(2)
    base = np.round(rng.normal(size=(200, 4)) * 64) * [[1, 40, 600, 9000]] / 64
    vectors = dict(enumerate(np.column_stack([base, base[:, 1] + base[:, 2], np.full(200, 7.0)]).astype(np.float32)))
    check(whitening.whiten(_frame(spark, vectors)).collect(), vectors)


def test_copies_ids_and_few_rows(spark):
    rows = [(7, [0.0, 1.0])] * 3 + [(None, [1.0, 0.0]), (None, [2.0, 0.5])]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 10 and {r["n"] for r in got} == {5} and sum(r["vec_id"] == 7 for r in got) == 6
    assert whitening.whiten(spark.createDataFrame(rows[:3], SCHEMA)).count() == 0  # no variance, no component
    assert whitening.whiten(spark.createDataFrame(rows[:1], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).count() == 0


def test_entries_beyond_the_grid(spark):
    rows = [(i, [1e38 * (i % 3), 3e9 * i, float(i)]) for i in range(9)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"] for r in got} == set(range(9)) and all(r["identity_error"] < 1e-4 for r in got)


def test_exact_products_of_great_and_small_rows():
    rng = np.random.default_rng(3)
    y = np.floor(rng.normal(size=(500, 5)) * 10.0 ** rng.integers(0, 15, size=(500, 1)))
    whole = y.astype(object)
    want = np.array([[sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j])) for j in range(5)] for i in range(5)], dtype=object)
    assert (whitening.exact_products(y) == want).all() and whole.shape == y.shape
    assert list(whitening.column_totals(y)) == [sum(int(a) for a in y[:, i]) for i in range(5)]


def test_factors():
    rng = np.random.default_rng(4)
    for d, rank in ((1, 1), (5, 5), (9, 4), (16, 16)):
        a = rng.normal(size=(d, rank)) * 10.0 ** rng.integers(-4, 4, size=(1, rank))
        c = (a @ a.T).astype(np.longdouble)
        factor = whitening.pivoted_cholesky(c)
        assert np.abs(factor @ factor.T - c).max() <= 1e-13 * c.max()
        turned = whitening.orthogonal_columns(factor)
        assert np.abs(turned @ turned.T - c).max() <= 1e-13 * c.max()
        gram = turned.T @ turned
        norms = np.sqrt(gram.diagonal())
        assert np.abs(gram / np.outer(norms, norms) - np.eye(len(norms))).max() < 1e-15


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_registered_query(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    found = QUERIES["op13_whiten"](spark, FOLDER)
    assert dict(found.dtypes)["deviation"] == "bigint"
    check(found.collect(), vectors)
