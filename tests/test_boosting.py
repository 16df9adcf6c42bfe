"""Boosted trees of several models, grown together level by level."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staywise.operators import boosting, models

FEATURES = ("a", "b", "c", "d")
PARAMS = models.BoostingParams(trees=4, depth=4, rate=0.3, min_rows=5, feature_subset="all", subsample=1.0)


@pytest.fixture(scope="module")
def mart(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(900, 4)), 2)
    x[:, 3] = rng.integers(0, 3, 900)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.5 * x[:, 3] + rng.normal(0, 0.3, 900) > 1.2).astype(int)
    rows = [(f"u{i}", *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "msno string, a double, b double, c double, d double, is_churn int")


def probs(model, mart):
    rows = model.transform(mart).select(vector_to_array("probability")[1].alias("p"), "msno").orderBy("msno").collect()
    return np.array([r["p"] for r in rows])


def test_trees_are_those_of_spark_ml(mart):
    rows = models.training_rows(mart, "is_churn", FEATURES)
    want = models._pipeline(FEATURES, PARAMS).fit(rows)
    got = models.train_churn(mart, PARAMS, FEATURES).pipeline
    assert np.allclose(probs(got, mart), probs(want, mart), atol=1e-12)
    a, b = got.stages[-1], want.stages[-1]
    assert [t.numNodes for t in a.trees] == [t.numNodes for t in b.trees]
    assert a.treeWeights == b.treeWeights and a.getMaxIter() == 4 and a.getStepSize() == 0.3
    assert np.allclose(a.featureImportances.toArray(), b.featureImportances.toArray())


def test_models_grown_together_equal_single_ones(mart, monkeypatch):
    """Also with draws of rows and features, other partitions and sums along a tree of tasks."""
    drawn = models.BoostingParams(trees=6, depth=3, rate=0.3, min_rows=5, feature_subset="0.5")
    fits = [models.churn_fit(mart.filter(f"d <> {k}"), f) for k, f in ((0, FEATURES), (1, FEATURES[:3]))]
    alone = [models.trained([f], drawn)[0] for f in fits]
    monkeypatch.setattr(boosting, "LEAST_ROWS", 100)
    monkeypatch.setattr(boosting, "MOST_ROWS", 150)
    monkeypatch.setattr(boosting, "DIRECT", 2)
    monkeypatch.setattr(boosting, "CHECKPOINT", 2)
    fits = [(rows.repartition(5), f) for rows, f in fits]
    for one, other in zip(alone, models.trained(fits, drawn)):
        assert np.allclose(probs(one.pipeline, mart), probs(other.pipeline, mart), atol=1e-9)


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    run()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))


def test_small_models_grow_without_a_job_a_level(spark, mart, monkeypatch):
    """Models that fit a partition grow in a task each, to the trees that jobs for each level give."""
    drawn = models.BoostingParams(trees=8, depth=4, rate=0.3, min_rows=5, feature_subset="0.5")
    fits = [models.churn_fit(mart.filter(f"d <> {k}"), FEATURES) for k in (0, 1)]
    found = []
    alone = jobs_of(spark, "alone", lambda: found.append(models.trained(fits, drawn)))
    monkeypatch.setattr(boosting, "ALONE_ROWS", 0)
    monkeypatch.setattr(boosting, "LEAST_ROWS", 100)
    monkeypatch.setattr(boosting, "CHECKPOINT", 3)
    spread = jobs_of(spark, "spread", lambda: found.append(models.trained(fits, drawn)))
    assert spread - alone >= 8 * 2
    for one, other in zip(*found):
        assert [t.numNodes for t in one.booster.trees] == [t.numNodes for t in other.booster.trees]
        assert np.allclose(probs(one.pipeline, mart), probs(other.pipeline, mart), atol=1e-9)


def test_one_job_a_level_for_all_folds_of_any_size(spark, mart, monkeypatch):
    monkeypatch.setattr(boosting, "ALONE_ROWS", 0)
    test_one_job_a_level_for_all_folds(spark, mart)


@pytest.mark.parametrize("plain", [0, 1000])
@pytest.mark.parametrize("weights", [(1.0, 3.5), tuple(range(1, 40))])
def test_histograms_are_sums_by_bin(weights, plain, monkeypatch):
    """Joint histograms of groups of features, for few and many kinds of rows, and those of few rows."""
    monkeypatch.setattr(boosting, "PLAIN_ROWS", plain)
    rng = np.random.default_rng(3)
    n, sizes = 700, [0, 1, 31, 31, 2, 12, 5, 31, 7, 1]
    cuts = [np.arange(k) + 0.5 for k in sizes]
    bins = np.stack([rng.integers(0, k + 1, n) for k in sizes])
    layout = boosting.layout_of(cuts)
    begins, group, bits, shift, groups = layout
    assert groups < len(cuts) and max(bits[group == g].sum() for g in range(groups)) <= boosting.CODE_BITS
    codes = np.zeros((groups, n), np.uint16)
    for f, values in enumerate(bins):
        codes[group[f]] |= (values << shift[f]).astype(np.uint16)
    sign, weight, margin, seen = rng.choice([-1.0, 1.0], n), rng.choice(weights, n), rng.normal(size=n), rng.random(n) < 0.8
    kinds, kind = np.unique(sign + 1j * weight, return_inverse=True)
    block = codes, kind, np.stack([kinds.real, kinds.imag]), np.zeros(n, np.uint64), margin, seen
    # The root asks feature 2, its left child feature 5; nodes 2, 3 and 4 are reached.
    feature, cut = np.full(31, -1), np.zeros(31, int)
    feature[:2], cut[:2] = (2, 5), (begins[2] + 14, begins[5] + 3)
    node = np.where(bins[2] > 14, 2, np.where(bins[5] > 3, 4, 3))
    found, square = boosting.histograms(block, feature, cut, np.array([2, 4]), layout, 1)
    pull = weight * 4 * sign / (1 + np.exp(2 * sign * margin))
    for k, at in enumerate((2, 4)):
        rows = seen & (node == at)
        assert np.isclose(square[k], (pull * pull / weight)[rows].sum())
        for f, values in enumerate(bins):
            for plane, amounts in enumerate((np.ones(n), weight, pull)):
                want = np.bincount(values[rows], weights=amounts[rows], minlength=sizes[f] + 1)
                assert np.allclose(found[plane, k, begins[f] : begins[f + 1]], want)


def test_one_job_a_level_for_all_folds(spark, mart):
    """Jobs grow with trees and levels, not with the number of models."""
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for folds in (2, 5):
        group = f"folds-{folds}"
        spark.sparkContext.setJobGroup(group, group)
        fits = [(models.training_rows(mart.filter(F.expr(f"hash(msno) % {folds} <> {k}")), "is_churn", FEATURES), FEATURES) for k in range(folds)]
        boosting_jobs = len(tracker.getJobIdsForGroup(group))
        rows = [r.cache() for r, _ in fits]
        models.trained([(r, FEATURES) for r in rows], models.BoostingParams(trees=20, depth=3, min_rows=5))
        jobs.append(len(tracker.getJobIdsForGroup(group)) - boosting_jobs)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] - jobs[0] < 60


def test_odd_training_rows(spark, mart):
    with pytest.raises(ValueError):
        models.train_churn(mart.limit(0), PARAMS, FEATURES)
    # One label only, and a feature without any spread.
    flat = mart.selectExpr("msno", "a", "b", "c", "1D AS d", "1 AS is_churn").limit(40)
    assert (probs(models.train_churn(flat, PARAMS, FEATURES).pipeline, flat) > 0.5).all()


def test_thresholds():
    assert boosting.thresholds(np.array([3.0, 1.0, 1.0]), np.ones(3)).tolist() == [2.0]
    assert boosting.thresholds(np.ones(5), np.ones(5)).tolist() == []
    cuts = boosting.thresholds(np.arange(10_000.0), np.ones(10_000))
    assert len(cuts) == 31 and np.all(np.abs(np.diff(cuts) - 312.5) <= 1)
