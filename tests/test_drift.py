import numpy as np
import pytest

from staywise.config import EngineConfig
from staywise.operators import drift

CFG = EngineConfig()


def numpy_psi(ref, cur):
    edges = np.histogram_bin_edges(ref, bins=10)
    r = np.clip(np.histogram(ref, bins=edges)[0] / len(ref), 1e-6, None)
    c = np.clip(np.histogram(cur, bins=edges)[0] / len(cur), 1e-6, None)
    return float(((c - r) * np.log(c / r)).sum())


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def pair(spark):
    rng = np.random.default_rng(3)
    ref = [(f"r{i}", float(rng.normal()), int(rng.integers(0, 30)), bool(rng.integers(0, 2)), 4.0, "t") for i in range(300)]
    cur = [(f"c{i}", float(rng.normal(0.5)), int(rng.integers(5, 40)), i % 5 == 0, 4.0, "t") for i in range(200)]
    schema = "msno string, a double, b int, c boolean, flat double, name string"
    return ref, cur, frame(spark, ref, schema), frame(spark, cur, schema)


def test_psi_equals_numpy(pair):
    ref, cur, reference, current = pair
    got = {r["feature"]: r for r in drift.psi_by_feature(reference, current, CFG).collect()}
    assert set(got) == {"a", "b", "c", "flat", "name"}
    for i, name in ((1, "a"), (2, "b"), (3, "c"), (4, "flat")):
        want = numpy_psi(np.array([r[i] for r in ref], float), np.array([r[i] for r in cur], float))
        assert got[name]["psi"] == pytest.approx(want, abs=1e-9)
        assert got[name]["drifted"] == (want > 0.2)
    assert got["name"]["psi"] is None and not got["name"]["drifted"]


def test_identical_frames_do_not_drift(pair):
    _, _, reference, _ = pair
    out = drift.psi_by_feature(reference, reference, CFG)
    assert {r["psi"] for r in out.collect()} == {0.0, None}
    summary = drift.drift_summary(out, CFG).first()
    assert (summary["dataset_drift_detected"], summary["total_features"], summary["drift_share"]) == (False, 5, 0.0)


def test_maximum_falls_into_the_last_bin_and_constants_get_a_range(spark):
    values = frame(spark, [(v, 0.0, 10.0) for v in (0.0, 3.0, 9.99, 10.0, 10.1)], "value double, lo double, hi double")
    bins = [r[0] for r in values.selectExpr(drift.bin_of(10)).collect()]
    assert bins == [0, 3, 9, 9, None]
    ranges = drift.feature_ranges(frame(spark, [(4.0,), (4.0,)], "flat double"), ["flat"]).first()
    assert (ranges["lo"], ranges["hi"]) == (3.5, 4.5)


def test_nulls_count_as_zero(spark):
    reference = frame(spark, [("a", None), ("b", 1.0)], "msno string, x double")
    current = frame(spark, [("a", 0.0), ("b", 1.0)], "msno string, x double")
    assert drift.psi_by_feature(reference, current, CFG).first()["psi"] == 0.0


def test_ks_equals_brute_force(pair):
    ref, cur, reference, current = pair
    got = {r["feature"]: r["ks_statistic"] for r in drift.ks_by_feature(reference, current).collect()}
    for i, name in ((1, "a"), (2, "b"), (3, "c")):
        x, y = np.array([r[i] for r in ref], float), np.array([r[i] for r in cur], float)
        at = np.unique(np.concatenate([x, y]))
        want = max(abs((x <= v).mean() - (y <= v).mean()) for v in at)
        assert got[name] == pytest.approx(want)


def test_retraining_decision(spark):
    def report(answer):
        return lambda: frame(spark, [(answer,)], "retraining_recommended boolean")

    def missing():
        raise FileNotFoundError

    def broken():
        raise ValueError

    assert drift.should_retrain(broken, force=True)
    assert drift.should_retrain(report(True)) and not drift.should_retrain(report(False))
    assert drift.should_retrain(missing)
    with pytest.raises(ValueError):
        drift.should_retrain(broken)


def test_a_stored_profile_gives_the_same_report(spark, pair):
    _, _, reference, current = pair
    parts = [drift.reference_profile(reference.filter(f"abs(hash(msno)) % 3 {sign} 0")) for sign in ("=", "<>")]
    stored = drift.merged_profiles(*parts)
    for ours, direct in (
        (drift.psi_against(stored, current, CFG), drift.psi_by_feature(reference, current, CFG)),
        (drift.ks_against(stored, current), drift.ks_by_feature(reference, current)),
    ):
        assert ours.columns == direct.columns
        assert {r[0]: r[1:] for r in ours.collect()} == {r[0]: r[1:] for r in direct.collect()}


def test_profiles_compare_shared_columns_only(spark, pair):
    _, _, reference, current = pair
    stored = drift.reference_profile(reference.drop("a"))
    assert {r[0] for r in drift.psi_against(stored, current.drop("b"), CFG).collect()} == {"c", "flat", "name"}
    assert drift.psi_against(stored.limit(0), current, CFG).count() == 0
    assert drift.psi_against(stored, current.limit(0), CFG).count() == 4
