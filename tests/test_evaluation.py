import numpy as np
import pytest

from staywise.operators import evaluation
from staywise.operators.ranking import exact_quantiles, running_totals


@pytest.fixture(scope="module")
def scores():
    rng = np.random.default_rng(5)
    return [(f"u{i}", round(float(rng.random()), 2), int(rng.random() < 0.2)) for i in range(500)]


@pytest.fixture(scope="module")
def scored(spark, scores):
    return spark.createDataFrame(scores, "msno string, churn_prob double, is_churn int")


def test_auc_equals_all_pairs(scored, scores):
    pos = np.array([s for _, s, y in scores if y])[:, None]
    neg = np.array([s for _, s, y in scores if not y])[None, :]
    want = ((pos > neg) + 0.5 * (pos == neg)).mean()
    assert evaluation.auc_roc(scored).first()[0] == pytest.approx(want)


def test_average_precision_and_curves(scored, scores):
    s, y = np.array([r[1] for r in scores]), np.array([r[2] for r in scores])
    want, recall = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        tp, flagged = y[s >= t].sum(), (s >= t).sum()
        want += (tp / y.sum() - recall) * tp / flagged
        recall = tp / y.sum()
    assert evaluation.average_precision(scored).first()[0] == pytest.approx(want)
    roc = {r["threshold"]: r for r in evaluation.roc_points(scored).collect()}
    assert len(roc) == len(set(s))
    assert roc[0.5]["tpr"] == pytest.approx(y[s >= 0.5].sum() / y.sum())
    assert roc[0.5]["fpr"] == pytest.approx((1 - y[s >= 0.5]).sum() / (1 - y).sum())
    pr = {r["threshold"]: r for r in evaluation.pr_points(scored).collect()}
    assert pr[0.5]["precision"] == pytest.approx(y[s >= 0.5].mean())


@pytest.mark.parametrize("slice_rows", [1, 7, 1000])
@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_do_not_depend_on_the_slices(spark, slice_rows, descending):
    rows = [(g, float(v * v), v % 5) for g in "ab" for v in range(40)]
    frame = spark.createDataFrame(rows, "g string, x double, n int")
    out = running_totals(frame, "x", ["n"], "g", descending, slice_rows).collect()
    assert len(out) == len(rows)
    for r in out:
        same = [n for g, x, n in rows if g == r["g"] and (x >= r["x"] if descending else x <= r["x"])]
        assert (r["cum_n"], r["all_n"]) == (sum(same), 80)


def test_area_of_billions_of_rows(spark):
    counts = spark.createDataFrame([(0.9, 4 * 10**9, 10**9), (0.1, 10**9, 5 * 10**9)], "threshold double, pos long, neg long")
    assert evaluation.auc_of_counts(counts).first()[0] == pytest.approx((4 * 5 + (4 * 1 + 1 * 5) / 2) / 30)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(2)
    data = {"a": rng.normal(size=101), "b": rng.integers(0, 4, 50).astype(float), "c": np.array([3.0])}
    rows = [(f, float(v)) for f, values in data.items() for v in values]
    out = exact_quantiles(spark.createDataFrame(rows, "f string, v double"), "f", "v", [0.0, 0.25, 0.5, 1.0])
    for r in out.collect():
        want = np.quantile(data[r["f"]], [0.0, 0.25, 0.5, 1.0])
        assert [r["q0"], r["q1"], r["q2"], r["q3"]] == pytest.approx(list(want))


def test_split_takes_an_exact_share_of_each_class(spark):
    rows = [(f"u{i}", int(i % 7 == 0)) for i in range(210)]
    frame = spark.createDataFrame(rows, "msno string, is_churn int")
    for draw in ("xxhash64(msno, 42)", "length(msno)"):
        out = evaluation.stratified_split(frame, draw).collect()
        assert len(out) == 210
        assert sum(r["is_validation"] for r in out if r["is_churn"] == 1) == 6
        assert sum(r["is_validation"] for r in out if r["is_churn"] == 0) == 36


def test_ties_at_the_cut_are_ranked_in_ranges(spark):
    """One draw for all: the first keys of each class are taken, whatever the ranges; copies count each."""
    rows = [(f"u{i:05d}", int(i % 3 == 0)) for i in range(3000)] + [("u00000", 1)] * 3
    frame = spark.createDataFrame(rows, "msno string, is_churn int").repartition(5)
    out = evaluation.stratified_split(frame, "7L", slice_rows=100).collect()
    assert len(out) == len(rows)
    for label in (0, 1):
        keys = sorted(k for k, y in rows if y == label)
        taken = sorted(r["msno"] for r in out if r["is_churn"] == label and r["is_validation"])
        assert taken == keys[: -(-len(keys) // 5)]


def test_class_weight(spark):
    frame = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "is_churn int")
    assert evaluation.class_weight(frame).first()[0] == 3.0
    flipped = spark.createDataFrame([(1,), (1,), (0,)], "is_churn int")
    assert evaluation.class_weight(flipped).first()[0] == 1.0
