"""Whitening against eigenvectors of the covariance."""

import numpy as np
import pytest
from conftest import DATA

from tidemark.llm import queries, whitening

RNG = np.random.default_rng(4)


def close(r):
    """Values, orthogonality and residuals of ``right_singular`` relative to the largest value."""
    values, vectors = whitening.right_singular(r)
    want = np.linalg.svd(r, compute_uv=False)
    size = max(want[0], 1e-100)
    return max(
        np.abs(values - want).max() / size,
        np.abs(vectors.T @ vectors - np.eye(len(r))).max(),
        np.abs(r.T @ (r @ vectors) - vectors * values**2).max() / size**2,
    )


@pytest.mark.parametrize("n", [1, 2, 3, 7, 33, 64, 128])
def test_singular_values_and_vectors(n):
    assert close(whitening.triangle([RNG.normal(size=(3 * n, n))])) < 1e-11


def test_hard_matrices():
    turn = lambda n: np.linalg.qr(RNG.normal(size=(n, n)))[0]
    ties = turn(32) * np.repeat([4.0, 3, 2, 1], 8) @ turn(32)
    near = turn(40) * (1 + 1e-7 * np.arange(40)) @ turn(40)
    for r in (np.zeros((4, 4)), np.eye(8), np.diag([3.0, 3, 2, 0, 0, 1]), turn(20), ties, near):
        assert close(r) < 1e-8
    for _ in range(200):
        n = RNG.integers(1, 10)
        assert close(RNG.integers(-2, 3, size=(n, n)).astype(float)) < 1e-9


def test_small_values_are_accurate_relatively():
    """A bidiagonal matrix fixes even its least singular values to many digits; dqds keeps them."""
    a, b = np.logspace(0, -12, 12), np.logspace(-0.5, -12.5, 11)
    got = np.sqrt(whitening.squares(a, b))
    # The inverse's largest value is the least value's inverse.
    inverse = np.linalg.inv(np.diag(a) + np.diag(b, 1))
    assert abs(got[-1] * np.linalg.norm(inverse, 2) - 1) < 1e-10


def expected(rows, components=16):
    """By numpy's eigenvectors: {id: (deviation, |whitened| per component)}, explained."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.floor(np.array([v for _, v in good], np.float32).astype(float) * 64).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    y = fit - sums / n
    e, v = np.linalg.eigh(y.T @ y / n)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    dev = ((n * x - sums) ** 2).sum(axis=1)
    return good, n, dev, np.abs((x - sums / n) @ v / np.sqrt(e)), e / np.trace(y.T @ y / n)


def test_query_on_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect()]
    good, n, dev, want, explained = expected(rows)
    got = queries.QUERIES["op13_whitened_embeddings"](spark, DATA).collect()
    assert got[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    assert len(got) == 16 * len(good)
    at = {i: k for k, (i, _) in enumerate(good)}
    for r in got:
        assert (r.n, r.deviation) == (n, dev[at[r.vec_id]])
        assert abs(abs(r.whitened) - want[at[r.vec_id], r.component - 1]) < 1e-6
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9 and r.identity_error == got[0].identity_error


SCHEMA = "vec_id bigint, embedding array<float>, n string, _cells string, label int"


def test_odd_rows(spark):
    """Nulls, non-finite entries, other lengths, repeats, one direction without spread, clashing columns."""
    rng = np.random.default_rng(1)
    rows = [(i, [*rng.normal(size=5).tolist(), 0.5], "n", "c", None) for i in range(60)]
    rows += [(100 + i, rows[i % 3][1], None, None, i) for i in range(40)]
    odd = [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0]), (204, []), (205, [1.0])]
    df = spark.createDataFrame(rows + [(i, v, "n", "c", 0) for i, v in odd] + [(None, rows[0][1], "n", "c", 0)], SCHEMA)
    got = whitening.whitened(df).collect()
    good, n, dev, want, explained = expected([(r[0], r[1]) for r in rows], 5)
    assert n == 60 and {r.vec_id for r in got} == {i for i, _ in good} | {None}
    assert len(got) == 5 * 101
    at = {i: k for k, (i, _) in enumerate(good)} | {None: 0}
    for r in got:
        assert (r.n, r.deviation, r._cells) == (60, dev[at[r.vec_id]], r._cells)
        assert abs(abs(r.whitened) - want[at[r.vec_id], r.component - 1]) < 1e-9
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-9
    assert whitening.whitened(df).columns == ["vec_id", "embedding", "_cells", "label", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_nothing_to_fit(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], "", "", 0), (2, [1.0, 2.0], "", "", 0), (3, None, "", "", 0)], SCHEMA)
    assert whitening.whitened(df).count() == 0
    assert whitening.whitened(df.limit(0)).count() == 0


def test_many_parts_are_joined_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "JOINED", 3)
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(20)
    good, n, dev, want, _ = expected(rows, 4)
    got = whitening.whitened(df, components=3).collect()
    assert len(got) == 900 and all(abs(abs(r.whitened) - want[r.vec_id, r.component - 1]) < 1e-9 for r in got)


def test_differences_to_the_mean_are_exact():
    n, sums = 3_000_000_000, np.array([3_000_000_000 * 1_000_000 + 7], np.int64)
    x = np.array([[1_000_003]], np.int64)
    assert whitening.scaled(x, n, sums).tolist() == [[3 * n - 7]]
