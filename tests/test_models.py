from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staywise.config import EngineConfig
from staywise.operators import models, treeshap

CFG = EngineConfig()
FEATURES = ("a", "b", "c", "d")
PARAMS = models.BoostingParams(trees=4, depth=4, rate=0.3, min_rows=5, feature_subset="all")


@pytest.fixture(scope="module")
def mart(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 4))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.3, 400) > 0.8).astype(int)
    rows = [(f"u{i}", *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "msno string, a double, b double, c double, d double, is_churn int")


@pytest.fixture(scope="module")
def model(mart):
    return models.train_churn(mart, PARAMS, FEATURES)


def raw_scores(mart, model):
    out = model.pipeline.transform(mart).select(vector_to_array("features").alias("x"), vector_to_array("rawPrediction")[1].alias("z"))
    rows = out.collect()
    return np.array([r["x"] for r in rows]), np.array([r["z"] for r in rows])


def test_attributions_add_up_to_the_score(mart, model):
    x, z = raw_scores(mart, model)
    leaves = treeshap.leaves_of(model.booster)
    got = treeshap.attributions(x, leaves)
    # rawPrediction is the tree sum, whose double is the log-odds.
    assert np.allclose(got.sum(axis=1) + treeshap.base_value(leaves), 2 * z)


def test_attributions_equal_the_definition(mart, model):
    """Against Shapley values summed over all feature subsets."""
    x, _ = raw_scores(mart, model)
    leaves = treeshap.leaves_of(model.booster)

    def value(row, known):
        total = 0.0
        for leaf in leaves:
            product = leaf.value
            for f, lo, hi, share in zip(leaf.features, leaf.above, leaf.upto, leaf.share):
                product *= float(lo < row[f] <= hi) if f in known else share
            total += product
        return total

    got = treeshap.attributions(x[:5], leaves)
    for row, phi in zip(x[:5], got):
        for i in range(4):
            rest = [j for j in range(4) if j != i]
            want = sum(
                factorial(k) * factorial(3 - k) / factorial(4) * (value(row, {*s, i}) - value(row, set(s)))
                for k in range(4)
                for s in combinations(rest, k)
            )
            assert phi[i] == pytest.approx(want)


def leaf_by_leaf(rows, leaves):
    """Quadrature for each leaf on its own."""
    out = np.zeros_like(rows)
    for leaf in leaves:
        depth = len(leaf.features)
        passes = ((rows[:, leaf.features] > leaf.above) & (rows[:, leaf.features] <= leaf.upto)).astype(float)
        nodes, weights = np.polynomial.legendre.leggauss(depth // 2 + 1)
        for node, weight in zip((nodes + 1) / 2, weights / 2):
            factors = leaf.share * (1 - node) + passes * node
            out[:, leaf.features] += leaf.value * weight * (passes - leaf.share) * factors.prod(axis=1, keepdims=True) / factors
    return out


def test_blocks_equal_single_leaves(mart, model, monkeypatch):
    """Tabled patterns, and integration where paths are longer, agree with leaf by leaf."""
    x, _ = raw_scores(mart, model)
    leaves = treeshap.leaves_of(model.booster)
    want = leaf_by_leaf(x, leaves)
    assert np.allclose(treeshap.attributions(x, leaves), want, atol=1e-12)
    monkeypatch.setattr(treeshap, "TABLED", 1)
    monkeypatch.setattr(treeshap, "LEAVES", 3)
    monkeypatch.setattr(treeshap, "ROWS", 7)
    assert np.allclose(treeshap.attributions(x, leaves), want, atol=1e-12)
    assert treeshap.attributions(x, [treeshap.Leaf(1.0, *[np.zeros(0, int)] + [np.zeros(0)] * 3)]).any() == 0


def test_neighbouring_leaves_share_lookups(mart, model):
    """Groups ask few conditions for several leaves each; values that are no numbers pass nothing."""
    x, _ = raw_scores(mart, model)
    leaves = treeshap.leaves_of(model.booster)
    forest = treeshap.forest_of(leaves)
    assert 0 < 2 * len(forest.groups) <= len(leaves) - len(forest.single)
    assert all(len(g.conditions) <= treeshap.TABLED for g in forest.groups)
    odd = x.copy()
    odd[::3, 0], odd[1::3, -1], odd[2::3, 1] = np.nan, np.inf, -np.inf
    for rows in (odd, x[:0]):
        assert np.allclose(treeshap.attributions(rows, leaves), leaf_by_leaf(rows, leaves), atol=1e-12)


def test_leaves_come_from_the_node_table(model):
    """Every leaf of the model once, with the interval and shares of its path."""
    leaves = treeshap.leaves_of(model.booster)
    assert len(leaves) == sum((t.numNodes + 1) // 2 for t in model.booster.trees)
    walked = []

    def walk(node, weight, path):
        if node.subtreeDepth() == 0:
            walked.append((round(weight * 2 * node.prediction(), 12), tuple(sorted((f, *map(lambda v: round(v, 12), p)) for f, p in path.items()))))
            return
        f, cut, total = node.split().featureIndex(), node.split().threshold(), node.impurityStats().count()
        lo, hi, share = path.get(f, (-np.inf, np.inf, 1.0))
        walk(node.leftChild(), weight, {**path, f: (lo, min(hi, cut), share * node.leftChild().impurityStats().count() / total)})
        walk(node.rightChild(), weight, {**path, f: (max(lo, cut), hi, share * node.rightChild().impurityStats().count() / total)})

    for weight, tree in zip(model.booster.treeWeights, model.booster._java_obj.trees()):
        walk(tree.rootNode(), weight, {})
    found = [(round(f.value, 12), tuple((int(a), *(round(float(v), 12) for v in rest)) for a, *rest in zip(f.features, f.above, f.upto, f.share))) for f in leaves]
    assert sorted(found) == sorted(walked)


def test_folds_at_once_equal_separate_fits(mart):
    """The five folds' areas are those of five fits on their own."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    # Without random rows and features, which depend on the partitions.
    params = models.BoostingParams(trees=3, depth=3, rate=0.3, min_rows=5, subsample=1.0, feature_subset="all")
    row = models.cross_validate(mart, params, FEATURES).first()
    rows = models.training_rows(mart, "is_churn", FEATURES).withColumn("fold", F.expr(f"pmod(xxhash64(msno, {params.seed}), 5)"))
    areas = []
    for k in range(5):
        fitted = models._pipeline(FEATURES, params).fit(rows.filter(f"fold <> {k}"))
        areas.append(BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR").evaluate(fitted.transform(rows.filter(f"fold = {k}"))))
    assert row["folds"] == 5
    assert row["mean_auc_pr"] == pytest.approx(np.mean(areas), abs=1e-6)
    assert row["std_auc_pr"] == pytest.approx(np.std(areas), abs=1e-6)


def test_scores_flags_and_explained_rows(mart, model):
    scored = models.score_users(mart, model, CFG)
    rows = models.score_and_explain(mart, model, CFG).collect()
    by_user = {r["msno"]: r for r in rows}
    assert all(by_user[r["msno"]]["churn_prob"] == r["churn_prob"] for r in scored.collect())
    assert len(rows) == 400
    flagged = [r for r in rows if r["churn_flag"] == 1]
    assert 0 < len(flagged) < 400
    assert all((r["churn_prob"] >= 0.65) == (r["churn_flag"] == 1) for r in rows)
    assert all((r["shap_a"] is not None) == (r["churn_flag"] == 1) for r in rows)


def test_missing_features_are_zero(mart, model):
    zeroed = mart.selectExpr("msno", "a", "b", "c", "0D AS d")
    a = models.score_users(mart.drop("d"), model, CFG).orderBy("msno").collect()
    assert a == models.score_users(zeroed, model, CFG).orderBy("msno").collect()


def test_uplift_and_storage(mart, model, tmp_path):
    treatments = mart.selectExpr(
        "*",
        "if(hash(msno) % 2 = 0, 'no_treatment', 'discount_offer') AS intervention_type",
        "is_churn = 1 AS observed_churn",
    )
    treated, control = models.train_uplift(treatments, PARAMS, FEATURES)
    uplift = models.uplift_scores(mart, treated, control, "msno")
    p = {n: {r["msno"]: r["churn_prob"] for r in models.score_users(mart, m, CFG).collect()} for n, m in (("t", treated), ("c", control))}
    for r in uplift.limit(20).collect():
        assert r["uplift_score"] == pytest.approx(p["c"][r["msno"]] - p["t"][r["msno"]])

    # A treated model that knows the treatment is asked about each of them.
    kinds = treatments.withColumn("intervention_type_encoded", F.expr("if(hash(msno) % 2 = 0, 0, 1 + int(b > 0))"))
    knowing, plain_control = models.train_uplift(kinds, PARAMS, (*FEATURES, models.TREATMENT))
    assert plain_control.features == FEATURES and models.TREATMENT in knowing.features
    each = models.uplift_by_treatment(mart, knowing, plain_control, "msno").collect()
    assert any(r["uplift_discount_offer"] != r["uplift_personal_outreach"] for r in each)
    best = {r["msno"]: r["uplift_score"] for r in models.uplift_scores(mart, knowing, plain_control, "msno").collect()}
    assert all(best[r["msno"]] == max(v for k, v in r.asDict().items() if k != "msno") for r in each)

    models.save_model(treated, str(tmp_path), "uplift_treatment", trees=4)
    loaded = models.load_model(str(tmp_path), "uplift_treatment")
    assert loaded.features == FEATURES
    assert models.load_metadata(str(tmp_path), "uplift_treatment")["facts"] == {"trees": "4"}
    assert models.score_users(mart, loaded, CFG).collect() == models.score_users(mart, treated, CFG).collect()
    assert models.load_model(str(tmp_path), "nothing") is None

    plain = models.score_and_explain(mart, model, CFG)
    assert plain.filter("uplift_score IS NOT NULL").count() == 0
    full = models.score_and_explain(mart, model, CFG, (treated, control))
    assert full.filter("(uplift_score IS NULL) = (churn_flag = 1)").count() == 0
    want = {r["msno"]: r["uplift_score"] for r in uplift.collect()}
    assert all(r["uplift_score"] == want[r["msno"]] for r in full.filter("churn_flag = 1").collect())
    summary = models.uplift_summary(full, CFG).first()
    assert summary["scored_users"] == full.filter("churn_flag = 1").count()


def test_importance_and_cross_validation(spark, mart, model):
    ranked = models.feature_importance(spark, model, 3).collect()
    assert ranked[0]["feature"] in ("a", "b", "c") and len(ranked) == 3
    row = models.cross_validate(mart, models.BoostingParams(trees=2, depth=2, feature_subset="all"), FEATURES, folds=2).first()
    assert 0 < row["mean_auc_pr"] <= 1
