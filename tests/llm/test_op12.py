"""Whitening against a dense eigendecomposition."""

import math

import numpy as np
import pytest

import __spark_entry__ as entry

from lendlens.llm import whitening as W
from tests.conftest import SMOKE_DIR

FIELDS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(vectors, components=4, scale=256):
    """[(integer vector, exact deviation, whitened values)], n, explained of the usable vectors, by numpy alone."""
    x = [[math.floor(scale * c) for c in v] for v in vectors]
    fit = np.unique(np.array(x, dtype=np.int64), axis=0)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    mean = fit.sum(axis=0) / n
    cov = (fit - mean).T @ (fit - mean) / n
    values, q = np.linalg.eigh(cov)
    values, q = values[::-1], q[:, ::-1]
    k = min(components, len(values))
    out = [(sum((n * a - s) ** 2 for a, s in zip(row, sums)), (np.array(row) - mean) @ q[:, :k] / np.sqrt(values[:k])) for row in x]
    return out, n, values[:k] / np.trace(cov)


def test_query_equals_dense_decomposition(spark):
    rows = spark.read.parquet(f"{SMOKE_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    want, n, explained = plain([r["embedding"] for r in rows])
    out = entry.queries()["op12_embedding_whitening"](spark, SMOKE_DIR)
    assert out.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                          ("explained", "double"), ("identity_error", "double")]
    got = out.orderBy("vec_id", "component").collect()
    assert [(r["vec_id"], r["component"]) for r in got] == [(r["vec_id"], c) for r in rows for c in (1, 2, 3, 4)]
    assert all(r["n"] == n and r["identity_error"] < 1e-10 for r in got) and len({r["identity_error"] for r in got}) == 1
    assert [r["deviation"] for r in got[::4]] == [d for d, _ in want]
    assert np.allclose([r["explained"] for r in got[:4]], explained, rtol=1e-12)
    ours, theirs = np.array([r["whitened"] for r in got]).reshape(-1, 4), np.array([w for _, w in want])
    signs = np.sign((ours * theirs).sum(axis=0))
    assert np.allclose(ours * signs, theirs, atol=1e-9)


def scatter(x):
    return (x - x.mean(axis=0)).T @ (x - x.mean(axis=0))


@pytest.mark.parametrize("kind", ["normal", "low rank", "scales", "repeated", "corners", "one column"])
@pytest.mark.parametrize("cuts", [1, 3, 40])
def test_spectrum_is_that_of_the_scatter(kind, cuts):
    r = np.random.default_rng(5)
    x = {"normal": np.floor(r.normal(size=(300, 24)) * 40), "low rank": np.floor(r.normal(size=(200, 3)) * 9) @ np.floor(r.normal(size=(3, 12)) * 5),
         "scales": np.floor(r.normal(size=(200, 8)) * np.array([1e9, 1e9, 1e3, 1, 1, 0, 0, 1e6])), "repeated": np.tile(np.eye(6) * 7, (20, 1)),
         "corners": np.vstack([np.eye(32) * 3, np.zeros((20, 32))]), "one column": np.floor(r.normal(size=(99, 1)) * 9)}[kind]
    whole, parts = W.Spectrum(x.shape[1]), []
    for part in np.array_split(x, cuts):
        one = W.Spectrum(x.shape[1])
        one.add(part)
        parts.append(one)
    for one in parts:
        whole.combine(W.Spectrum.unpacked(*one.packed(), x.shape[1]))
    want = scatter(x)
    assert whole.n == len(x) and np.allclose(whole.mean, x.mean(axis=0))
    assert np.abs(whole.vectors @ np.diag(whole.values) @ whole.vectors.T - want).max() <= 1e-12 * np.abs(want).max()
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(x.shape[1])).max() < 1e-12
    assert np.abs(whole.values - np.linalg.eigvalsh(want)).max() <= 1e-12 * np.abs(want).max()


def test_roots_interlace():
    r = np.random.default_rng(9)
    for _ in range(200):
        n = r.integers(1, 12)
        d = np.sort(r.normal(size=n) * 10.0 ** r.integers(-3, 4))
        z2 = 10.0 ** r.uniform(-9, 3, size=n)
        if n > 1 and np.diff(d).min() <= 0:
            continue
        origin, x = W._roots(d, z2)
        roots = d[origin] + x
        assert (roots >= d).all() and (roots[:-1] <= d[1:]).all()
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(z2), np.sqrt(z2)))
        assert np.allclose(roots, want, atol=1e-12 * max(np.abs(want).max(), 1e-300))


def test_edge_rows(spark):
    r = np.random.default_rng(2)
    good = [[float(c) for c in v] for v in r.normal(size=(40, 5))]
    rows = [(k, v) for k, v in enumerate(good)] + [(1, good[1]), (1, good[2]), (None, good[3]), (90, None), (91, []), (92, [None] + good[0][1:]),
            (93, [float("nan")] + good[0][1:]), (94, [float("inf")] + good[0][1:]), (95, [1e300] + good[0][1:]), (96, good[0][:4]), (97, [-0.0] * 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'a' AS label", "'b' AS n", "3 AS x")
    out = W.whiten(df)
    assert out.columns == ["vec_id", "label", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    usable = good + [good[1], good[2], good[3], [0.0] * 5]
    want, n, _ = plain(usable)
    assert n == 41 and len(got) == 4 * len(usable) and {g["n"] for g in got} == {41} and got[0]["identity_error"] < 1e-10
    assert sorted(g["deviation"] for g in got if g["component"] == 1) == sorted(d for d, _ in want)
    # Rows with the same vector have the same results.
    assert len({g["whitened"] for g in got if g["component"] == 2}) == 41


def test_degenerate_tables(spark):
    def run(rows, **options):
        return W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), **options).orderBy("vec_id", "component").collect()

    assert run([]) == [] and run([(1, None), (2, [])]) == []
    assert [tuple(r) for r in run([(1, [0.5, 2.0]), (2, [0.5, 2.0])])] == [
        (i, c, 1, 0, 0.0, 0.0, 1.0) for i in (1, 2) for c in (1, 2)]  # no variance: nothing to scale
    line = run([(k, [float(k), 1.0]) for k in range(4)])
    assert [r["component"] for r in line] == [1, 2] * 4 and line[0]["explained"] == 1.0 and line[1]["whitened"] == 0.0
    assert np.allclose([abs(r["whitened"]) for r in line[::2]], np.abs(np.arange(4) - 1.5) / np.std(np.arange(4)))
    # Ties of lengths go to the longer vectors; sums and deviations beyond 64 bits don't wrap.
    assert {r["vec_id"] for r in run([(1, [1.0]), (2, [1.0, 2.0])])} == {2}
    big = run([(1, [1e13, 0.0]), (2, [-1e13, 0.0]), (3, [0.0, 1.0])])
    assert [r["deviation"] for r in big if r["component"] == 1] == [None, None, (3 * 0) ** 2 + (3 * 256 - 256) ** 2]


def test_partitions_do_not_matter(spark):
    df = spark.read.parquet(f"{SMOKE_DIR}/embeddings.parquet").select("vec_id", "embedding")
    a = W.whiten(df.repartition(37)).orderBy("vec_id", "component").collect()
    b = W.whiten(df.coalesce(1)).orderBy("vec_id", "component").collect()
    assert np.allclose([r["whitened"] for r in a], [r["whitened"] for r in b], atol=1e-9)
    assert [r["deviation"] for r in a] == [r["deviation"] for r in b]


def test_trees_of_many_parts(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN_IN", 3)
    fit, dim = W.integer_vectors(spark.read.parquet(f"{SMOKE_DIR}/embeddings.parquet"), "embedding")
    many = fit.repartition(40)
    x = np.array([r["x"] for r in fit.collect()], dtype=np.float64)
    whole = W.spectrum(many, dim)
    assert np.allclose(whole.vectors @ np.diag(whole.values) @ whole.vectors.T, scatter(x), atol=1e-9 * np.abs(scatter(x)).max())
    basis = np.linalg.qr(np.random.default_rng(1).normal(size=(dim, 5)))[0]
    got = W.projected_scatter(many, dim, x.mean(axis=0), basis)
    assert np.allclose(got, basis.T @ scatter(x) @ basis)
    assert W.totals(many, dim) == (len(x), [int(s) for s in x.sum(axis=0)])
