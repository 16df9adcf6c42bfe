"""Whitening against a dense eigenvalue decomposition, and odd tables."""

import numpy as np
import pytest

from staywise.llm import whitening

KINDS = "vec_id long, embedding array<double>, n int, component string"


def vectors(spark, rows):
    """Rows (vec_id, vector); further columns clash with those of the result."""
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 7, "x") for i, v in rows], KINDS)


def expected(rows, wanted=32):
    x = np.floor(64 * np.array(rows, float)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:wanted]
    return n, ((n * x - sums).astype(object) ** 2).sum(axis=1), values[order], axes[:, order], centred, values.sum()


def agrees(found, rows, wanted=32, tolerance=1e-8):
    n, deviations, values, axes, centred, trace = expected(rows, wanted)
    by = {(r.vec_id, r.component): r for r in found}
    assert len(by) == len(found) == n * len(values)
    for k, value in enumerate(values):
        mine = np.array([by[i, k + 1].whitened for i in range(n)])
        theirs = centred @ axes[:, k] / np.sqrt(value)
        assert min(np.abs(mine - theirs).max(), np.abs(mine + theirs).max()) < tolerance
        assert all(by[i, k + 1].explained == pytest.approx(value / trace, rel=1e-9) for i in range(n))
    assert all(r.n == n and r.deviation == deviations[r.vec_id] for r in found)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-8


def test_components_by_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    rows = rng.standard_normal((300, 12)) * np.linspace(1, 9, 12) + 5
    agrees(whitening.whitened(vectors(spark, enumerate(rows))).collect(), rows)


def test_ends_early_where_the_leading_ones_are_found(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = rng.standard_normal((200, 90)) * np.r_[np.linspace(60, 30, 20), np.ones(70)]
    passes, passed = [], whitening._passed
    monkeypatch.setattr(whitening, "_passed", lambda *a: passes.append(1) or passed(*a))
    agrees(whitening.whitened(vectors(spark, enumerate(rows)), wanted=4).collect(), rows, 4)
    assert len(passes) < 80


def dense(x):
    """Runs the search on a matrix in place of the table."""

    def passes(search):
        count, asked = 0, next(search)
        try:
            while True:
                values = x @ asked
                asked = search.send(np.r_[values.T @ values[:, -1], x.T @ values[:, -1]])
                count += 1
        except StopIteration as end:
            return end.value, count

    return passes


@pytest.mark.parametrize("seed", range(4))
def test_repeated_values_are_all_found(seed):
    rng = np.random.default_rng(seed)
    left, _ = np.linalg.qr(rng.standard_normal((400, 120)))
    right, _ = np.linalg.qr(rng.standard_normal((120, 120)))
    values = np.r_[9, 9, 9, 7, 7, 5, 4, 3, np.linspace(1, 0.1, 112)]
    x = left * values @ right.T
    (axes, found), _ = dense(x)(whitening.leading(120, 6, np.linalg.norm(x)))
    assert np.allclose(found, values[:6], rtol=1e-12)
    assert np.allclose(axes.T @ axes, np.eye(6), atol=1e-12)
    assert np.allclose(np.linalg.norm(x @ axes, axis=0), values[:6])


def test_low_rank_ends():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((60, 3)) @ rng.standard_normal((3, 80))
    (axes, found), count = dense(x)(whitening.leading(80, 32, np.linalg.norm(x)))
    assert np.allclose(found, np.linalg.svd(x)[1][:3]) and axes.shape == (80, 3) and count < 90


def test_odd_rows(spark):
    """Left out: null, null or non-finite entries. Each length is a list of its own."""
    rows = [(1, [1, 2]), (2, [3, 1]), (2, [3, 1]), (None, [5, 1]), (3, None), (4, [None, 1]), (5, [float("nan"), 1]), (6, [float("inf"), 1]), (7, []), (8, [1, 2, 3]), (9, [2, 2, 2]), (10, [4])]
    found = whitening.whitened(vectors(spark, rows)).collect()
    assert sorted((str(r.vec_id), r.component, r.n) for r in found) == sorted(
        [(i, k, 4) for i in ("1", "2", "2", "None") for k in (1, 2)] + [("8", 1, 2), ("9", 1, 2)]
    )
    assert len({(r.whitened, r.component) for r in found if r.vec_id == 2}) == 2  # repeated rows agree


def test_very_large_and_very_long(spark):
    """Beyond a long the deviation is null; vectors may be long."""
    found = whitening.whitened(vectors(spark, [(1, [1e200, 1]), (2, [0, 2]), (3, [0, 3])])).collect()
    assert {r.deviation for r in found} == {None} and all(np.isfinite(r.whitened) for r in found)
    rng = np.random.default_rng(2)
    rows = rng.integers(-9, 9, (6, 3000))
    agrees(whitening.whitened(vectors(spark, enumerate(rows)), wanted=3).collect(), rows, 3, 1e-7)


def test_no_deviation_and_empty(spark):
    assert whitening.whitened(vectors(spark, [(1, [1, 2]), (2, [1, 2])])).collect() == []
    empty = whitening.whitened(vectors(spark, [])).collect()
    assert empty == []
