"""Whitening against numpy's eigenvectors, on hostile fixtures and the smallest table."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermatch.llm import queries, whitening
from ledgermatch.llm.scratch import ship_package

SF = "/root/testdata/sf0.001"
CLASH = ("id", "v", "dim", "n", "sums", "i", "row", "j", "x", "component", "whitened")


def _grid(vectors, dim):
    kept = [(i, v) for i, v in vectors if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]
    return [i for i, _ in kept], np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in kept], np.int64).reshape(-1, dim)


def _check(rows, vectors, dim, components, tight=1e-7):
    ids, x = _grid(vectors, dim)
    n, sums = len(x), x.sum(axis=0)
    if not components:
        assert not rows
        return
    a = (n * x - sums) / n
    values, sides = np.linalg.eigh(a.T @ a / n)
    values, sides = values[::-1], sides[:, ::-1]
    assert sorted({r.component for r in rows}) == list(range(1, components + 1))
    by_key = {}
    for r in rows:
        by_key.setdefault((r.vec_id, r.component), []).append(r)
    exact = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    for k in range(components):
        got = np.concatenate([[r.whitened for r in by_key[i, k + 1]] for i in dict.fromkeys(ids)])
        want = np.concatenate([[(a[p] @ sides[:, k]) / np.sqrt(values[k]) for p in range(n) if ids[p] == i] for i in dict.fromkeys(ids)])
        got, want = np.sort(got), min((np.sort(want), np.sort(-want)), key=lambda w: np.abs(w - np.sort(got)).max())
        assert np.abs(got - want).max() < tight
    for r in rows:
        assert r.n == n and r.identity_error < 1e-10
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.deviation in {exact[p] for p in range(n) if ids[p] == r.vec_id}


def _frame(spark, vectors):
    ship_package(spark)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    return df.withColumns({c: F.lit("mine") for c in CLASH})


def test_rows_that_cannot_be_used_are_left_out(spark):
    rng = np.random.RandomState(0)
    vectors = [(i, [float(np.float32(v)) for v in rng.randn(10) * np.linspace(3, 0.2, 10)]) for i in range(60)]
    vectors += [(5, vectors[5][1]), (None, vectors[7][1]), (100, None), (101, []), (102, [None] * 10), (103, [float("nan")] * 10),
                (104, [float("inf")] + [0.0] * 9), (105, [1.0] * 9), (106, [-1.5] * 10), (107, [1e30] * 10)]
    rows = whitening.whiten(_frame(spark, vectors).repartition(5)).collect()
    _check(rows, [v for v in vectors if v[0] != 107], 10, 8)


@pytest.mark.parametrize("kind", ["few dimensions", "dependent", "scales", "equal", "one", "empty", "unusable"])
def test_degenerate_tables(spark, kind):
    rng = np.random.RandomState(1)
    base = rng.randn(200, 12)
    if kind == "few dimensions":
        base = base[:, :3]
    elif kind == "dependent":
        base[:, 5:] = np.stack([base[:, 0], base[:, 1], np.zeros(200), np.ones(200), base[:, 2], base[:, 0], base[:, 4]], axis=1)
    elif kind == "scales":
        base = base * np.logspace(3, -3, 12)
    elif kind == "equal":
        base[:] = base[0]
    elif kind == "one":
        base = base[:1]
    vectors = [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(base)] if kind not in ("empty", "unusable") else []
    vectors += [(1, None), (2, [None])] if kind == "unusable" else []
    rows = whitening.whiten(_frame(spark, vectors)).collect()
    _check(rows, vectors, len(base[0]), {"few dimensions": 3, "dependent": 5, "scales": 8}.get(kind, 0))


def test_factors_multiply_to_the_rows(spark):
    """A triangular solve undoes its factor, and ill-conditioned columns end orthonormal after some passes."""
    rng = np.random.RandomState(3)
    r = np.triu(rng.randn(6, 6)) + 4 * np.eye(6)
    rows = rng.randn(50, 6)
    assert np.allclose(whitening.solve_upper(rows, r) @ r, rows)
    x = rng.randn(3000, 6) * 50
    x[:, 5] = x[:, 4] + 0.02 * x[:, 5]
    df = _frame(spark, [(i, [float(np.float32(v)) for v in row]) for i, row in enumerate(x)])
    model = whitening.fit(df)
    assert 3 <= model.passes < whitening.MAX_PASSES
    assert np.abs(model.components.T @ model.components - np.eye(6)).max() < 1e-13


def test_exact_sums_of_squares():
    n, x = 3, np.array([[1 << 40, 5], [7, 9], [0, 0]], np.int64)
    sums = x.sum(axis=0)
    want = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, n, sums) == [w if w < 1 << 63 else None for w in want]
    assert Fraction(n * 5 - int(sums[1]), n) == Fraction(5) - Fraction(int(sums[1]), n)


def test_op11_whole_table(spark):
    rows = queries.op11_whitening(spark, SF).collect()
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    _check(rows, table, 64, 8)
    assert len(rows) == 8 * len(table)
