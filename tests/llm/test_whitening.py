"""Whitening against the plain eigenvectors of the covariance, and the solver on hard matrices."""

import math

import numpy as np
import pytest

from kempt.llm import bidiagonal, whitening
from kempt.llm.queries import QUERIES


def matrices():
    rng = np.random.default_rng(0)
    turn = lambda n: np.linalg.qr(rng.standard_normal((n, n)))[0]
    for n in (1, 2, 3, 8, 33):
        yield rng.standard_normal((n, n))
        yield turn(n)
        yield turn(n) * np.resize([3.0, 3.0, 2.0, 1.0], n) @ turn(n)
        yield rng.standard_normal((n, max(1, n // 2))) @ rng.standard_normal((max(1, n // 2), n))
        yield np.diag(rng.integers(0, 3, n).astype(float))
        yield rng.standard_normal((n, n)) * 10.0 ** -rng.integers(0, 8, n)
        yield np.zeros((n, n))
        yield turn(n) * (1 + 1e-9 * rng.standard_normal(n)) @ turn(n)


def test_singular_values_and_vectors():
    for m in matrices():
        triangle = np.linalg.qr(m, mode="r")
        diagonal, superdiagonal, rights = bidiagonal.reduced(triangle)
        values, vectors = bidiagonal.singular(diagonal, superdiagonal, 1e-22, len(m))
        true = np.linalg.svd(m, compute_uv=False)
        assert np.abs(np.sqrt(values) - true).max() <= 1e-13 * max(true.max(), 1e-300)
        z = bidiagonal.restored(vectors, rights)
        assert np.allclose(z.T @ z, np.eye(z.shape[1]), atol=1e-10)
        assert np.allclose(m.T @ (m @ z), z * values[:z.shape[1]], atol=1e-11 * max(true.max() ** 2, 1e-300))


def test_small_values_keep_their_digits():
    # Of a bidiagonal matrix with ones above a graded diagonal, the product of all values is that of the diagonal.
    diagonal = 10.0 ** -np.arange(12)
    values = bidiagonal.dqds(diagonal, 0.5 * diagonal[:-1])
    assert math.isclose(np.prod(np.sqrt(values)), np.prod(diagonal), rel_tol=1e-13)
    assert values[-1] < 1e-21


def plain(rows, limit=32):
    """Per key the exact deviation and the whitened row, from the eigenvectors of the covariance."""
    x = np.array([r for _, r in rows], np.int64)
    n = len(x)
    sums = x.sum(axis=0)
    centred = (x - sums // n) - (sums % n) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:limit], vectors[:, ::-1][:, :limit]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(r, sums, strict=True)) for r in x]
    return n, deviation, centred @ vectors / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def test_query_over_the_whole_table(spark, folder):
    given = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    rows = [(r["vec_id"], [math.floor(64 * float(c)) + 1_000_000 for c in r["embedding"]]) for r in given]
    n, deviation, whitened, explained = plain(rows)
    found = {}
    for r in QUERIES["op12_whitening"](spark, folder).collect():
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    assert found.keys() == {k for k, _ in rows}
    mine = np.array([[found[k][c]["whitened"] for c in range(1, 33)] for k, _ in rows])
    signs = np.sign((mine * whitened).sum(axis=0))
    assert np.allclose(mine * signs, whitened, atol=1e-8)
    for (k, _), d in zip(rows, deviation, strict=True):
        assert sorted(found[k]) == list(range(1, 33))
        for c, r in found[k].items():
            assert r["n"] == n and r["deviation"] == d and 0 <= r["identity_error"] <= 1e-9
            assert math.isclose(r["explained"], explained[c - 1], rel_tol=1e-9)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 1.0, 0.0]), (1, [0.5, 1.0, 0.0]), (2, None), (3, [nan, 1.0, 1.0]), (4, [1.0, inf, 0.0]), (5, [1.0, None, 0.0]),
        (6, [1.0]), (7, []), (None, [2.0, -1.0, 0.0]), (8, [-3.0, 0.25, 0.0]), (9, [1e30, 1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id bigint, embedding array<double>, key int, x string")
    points = whitening.on_grid(df, "vec_id", "embedding", 64, 1000)
    model = whitening.fit(points, 32)
    out = whitening.apply(points, model, "vec_id").collect()
    # The third place never varies.
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"]) for r in out) == [
        (False, 1, 1), (False, 1, 1), (False, 1, 2), (False, 1, 2), (False, 8, 1), (False, 8, 2), (True, 0, 1), (True, 0, 2),
    ]
    assert {r["n"] for r in out} == {4} and whitening.identity_error(points, model) < 1e-12
    assert math.isclose(sum({r["component"]: r["explained"] for r in out}.values()), 1)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)], [(1, [])], [(1, None)]])
def test_nothing_varies(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    points = whitening.on_grid(df, "vec_id", "embedding", 64, 1000)
    model = whitening.fit(points, 32)
    assert model is None and whitening.apply(points, model, "vec_id").collect() == []


def test_many_equal_rows_and_more_tasks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(5).tolist() if i % 3 else [1.0] * 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(40)
    points = whitening.on_grid(df, "vec_id", "embedding", 64, 1_000_000)
    model = whitening.fit(points, 3)
    assert whitening.identity_error(points, model) < 1e-10
    n, _, whitened, _ = plain([(k, [math.floor(64 * c) + 1_000_000 for c in v]) for k, v in rows], 3)
    mine = {r["vec_id"]: r["whitened"] for r in whitening.apply(points, model, "vec_id").where("component = 2").collect()}
    own = np.array([mine[k] for k, _ in rows])
    assert n == 3000 and np.allclose(own * np.sign(own @ whitened[:, 1]), whitened[:, 1], atol=1e-8)


def test_deviation_beyond_64_bits():
    model = whitening.Whitening(10**9, (0, 0), 1.0, np.ones(1), np.ones((2, 1)))
    assert whitening.deviations(np.array([[1, 2]]), model).tolist() == [5 * 10**18]
    with pytest.raises(OverflowError):
        whitening.deviations(np.array([[3, 2]]), model)
