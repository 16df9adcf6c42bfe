import numpy as np
import pytest

from staywise.config import EngineConfig
from staywise.operators import changepoint as cp

CFG = EngineConfig()


def brute_force(values, cfg):
    """Optimal segmentation by trying every last segment, from the full kernel matrix."""
    n = len(values)
    gaps = (values[:, None] - values[None, :]) ** 2
    middle = np.median(gaps[np.triu_indices(n, 1)])
    kernel = np.exp(-np.clip(gaps / (middle or 1.0), 1e-2, 1e2))
    np.fill_diagonal(kernel, 1.0)

    def cost(s, t):
        return (t - s) - kernel[s:t, s:t].sum() / (t - s)

    ends = [t for t in range(cfg.cp_grid, n, cfg.cp_grid)] + [n]
    best, last = {0: 0.0}, {}
    for t in ends:
        options = [(best[s] + cost(s, t), s) for s in best if t - s >= cfg.cp_min_size]
        best[t], last[t] = min(options)
        best[t] += cfg.cp_penalty
    return last[n] or None


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("penalty", [1.0, 3.0, 10.0])
def test_equals_brute_force(seed, penalty):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(20, 90)) // 5 * 5 + 3
    levels = np.repeat(rng.integers(0, 5, 4) * 1000.0, n // 4 + 1)[:n]
    values = levels + rng.normal(0, 300, n)
    cfg = EngineConfig(cp_penalty=penalty)
    assert cp.last_breakpoint(values, cfg) == brute_force(values, cfg)


def test_series_segmented_together(monkeypatch):
    """Blocks of many users, of one and of few; lengths that end inside a grid step; medians in blocks."""
    rng = np.random.default_rng(5)
    series = [rng.integers(0, 4, 5).repeat(n)[: n - n % 3] * 500.0 for n in (3, 14, 15, 16, 20, 21, 40, 40)]
    series = [v + rng.normal(0, 90, len(v)) for v in series] + [np.full(30, 7.0)]
    cfg = EngineConfig(cp_penalty=1.0)
    alone = [brute_force(v, cfg) if len(v) > 3 else None for v in series]
    assert any(alone)
    for cells, pairs in ((1 << 16, 1 << 20), (1, 1 << 20), (100, 500), (100, 1)):
        monkeypatch.setattr(cp, "BLOCK_CELLS", cells)
        monkeypatch.setattr(cp, "PAIR_CELLS", pairs)
        assert cp.last_breakpoints(series, cfg) == alone
    assert cp.last_breakpoints([], cfg) == cp.change_indexes([], cfg) == []
    assert cp.change_indexes([None, step(80, 40), step(13, 6)], CFG) == [None, cp.change_index(step(80, 40), CFG), None]


def step(n, at, low=100.0, high=9000.0):
    rng = np.random.default_rng(1)
    return np.where(np.arange(n) < at, low, high) + rng.normal(0, 20, n)


def test_guards():
    assert cp.change_index(step(13, 6), CFG) is None
    assert abs(cp.change_index(step(80, 40), CFG) - 40) <= CFG.cp_grid
    assert cp.change_index(step(80, 5), CFG) is None
    assert cp.change_index(np.full(60, 7.0), CFG) is None


@pytest.mark.parametrize("n", [7, 8, 50, 51])
def test_median_by_counting_equals_sorting(n):
    values = np.random.default_rng(n).integers(0, 500, n).astype(float)
    i, j = np.triu_indices(n, 1)
    assert cp.median_squared_gap(values) == pytest.approx(np.median((values[i] - values[j]) ** 2))


def test_statistics_around_a_step(spark):
    values = step(40, 20)
    rows = [("u", i, float(v)) for i, v in enumerate(values)] + [("short", 1, 5.0)]
    rollup = spark.createDataFrame(rows, "msno string, d int, day_secs double").selectExpr(
        "msno", "date_add(DATE'2017-01-01', d) AS log_date", "day_secs"
    )
    cfg = EngineConfig(cp_penalty=2.0)
    found = {r["msno"]: r for r in cp.detect_change_points(rollup, cfg).collect()}
    row, at = found["u"], cp.change_index(values, cfg)
    assert row["change_point_detected"] and (row["change_point_date"] - row["change_point_date"].replace(month=1, day=1)).days == at
    assert row["days_since_change_point"] == 39 - at
    assert row["pre_change_daily_mean"] == pytest.approx(values[:at].mean())
    assert row["usage_slope_post_change"] == pytest.approx(np.polyfit(np.arange(40 - at), values[at:], 1)[0])
    assert not found["short"]["change_point_detected"]
    assert found["short"]["pct_usage_change"] is None
