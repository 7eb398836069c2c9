"""Whitening against a plain eigendecomposition, and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm.queries import QUERIES
from faultline.llm.whitening import (Whitening, deviations, fit_whitening, integer_vectors, one_sided_jacobi, pair_rounds,
                                     pivoted_cholesky, whitened_rows)


def plain(vectors):
    """(n, S, V, integer rows) of lists of doubles, by the definition."""
    x = np.floor(64 * np.array(vectors, np.float64)).astype(np.int64) + 1_000_000
    y = x - x.sum(axis=0) / len(x)
    return len(x), x.sum(axis=0), y.T @ y / len(x), x


def test_query_against_eigh(spark, sf):
    got = QUERIES["op11_whitening"](spark, sf).toPandas()
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").filter("embedding IS NOT NULL").collect()
    n, sums, v, x = plain([r["embedding"] for r in rows])
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    assert len(got) == len(rows) * 32 and set(got["n"]) == {n}
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r["vec_id"] for r in rows]].to_numpy()
    want = ((n * x - sums) / n) @ vectors / np.sqrt(values)
    signs = np.sign((wide * want).sum(axis=0))
    assert np.abs(wide * signs - want).max() < 1e-8
    exact = {r["vec_id"]: sum((n * int(a) - int(s)) ** 2 for a, s in zip(xs, sums)) for r, xs in zip(rows, x)}
    assert (got["deviation"] == got["vec_id"].map(exact)).all()
    shares = got.groupby("component")["explained"].agg(["min", "max"])
    assert np.allclose(shares["min"], values / v.trace(), rtol=1e-10) and (shares["min"] == shares["max"]).all()
    cov = np.cov(wide.T, bias=True)
    assert got["identity_error"].nunique() == 1 and got["identity_error"][0] < 1e-10
    assert np.abs(cov - np.eye(32)).max() < 1e-8


def test_factor_and_rotation():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(9, 6)) * 10.0 ** -np.arange(6)
    v = a @ a.T  # rank 6 of 9, eigenvalues over ten orders of magnitude
    factor = pivoted_cholesky(v)
    assert factor.shape[1] <= 7 and np.allclose(factor @ factor.T, v, atol=1e-13 * v.max())
    values, vectors = one_sided_jacobi(factor)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    assert np.allclose(values[:4], want[:4], rtol=1e-8) and np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert (np.diff(values) <= 0).all()


@pytest.mark.parametrize("size", [1, 2, 5, 8])
def test_every_pair_once(size):
    pairs = [(int(p), int(q)) for ps, qs in pair_rounds(size) for p, q in zip(ps, qs)]
    assert sorted(pairs) == [(p, q) for p in range(size) for q in range(p + 1, size)]


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    base = [rng.normal(size=3).tolist() for _ in range(40)]
    odd = [None, [], [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 0.0, 0.0], [1.0, 2.0]]
    rows = [(n, v) for n, v in enumerate(base + base[:2] + odd)] + [(None, base[0]), (3, base[3])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    frame = frame.withColumns({c: F.lit("clash") for c in ("id", "x", "n", "whitened", "component", "deviation")})
    got = whitened_rows(frame).toPandas()
    n, sums, v, x = plain(base + base[:2] + [base[0], base[3]])
    assert set(got["n"]) == {44} and len(got) == 44 * 3 and got["vec_id"].isna().sum() == 3
    assert got["identity_error"].max() < 1e-12
    assert sorted(set(got["deviation"])) == sorted({sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums)) for r in x})


def test_fewer_components_than_columns(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
    assert whitened_rows(one).count() == 0 and whitened_rows(one.filter("false")).count() == 0
    flat = spark.createDataFrame([(n, [float(n), float(n), 7.0]) for n in range(9)], "vec_id bigint, embedding array<float>")
    got = whitened_rows(flat).toPandas()
    assert set(got["component"]) == {1} and np.isclose(got["explained"], 1).all() and got["identity_error"][0] < 1e-12


def test_large_entries(spark):
    huge = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 2.0])], "vec_id bigint, embedding array<double>")
    vectors = integer_vectors(huge)
    model = fit_whitening(vectors)
    assert isinstance(model, Whitening) and model.n == 3 and len(model.eigenvalues) == 1
    got = whitened_rows(huge).toPandas()
    assert got["deviation"].isna().sum() >= 2
    small = deviations(np.array([[1, 2], [5, 9]]), 2, [6, 11])
    assert small.to_pylist() == [(2 - 6) ** 2 + (4 - 11) ** 2, (10 - 6) ** 2 + (18 - 11) ** 2]
