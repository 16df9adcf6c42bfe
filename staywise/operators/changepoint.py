"""Behavioral change points: where a user's daily usage shifted for good.

Only the segmentation itself runs in Python, on arrays that hold at most one value per calendar
day, for many users at a time. All statistics around the change are Spark aggregates.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from staywise.config import EngineConfig
from staywise.functions.columns import columns

# Kernel distances are kept inside this range.
DISTANCE_RANGE = (1e-2, 1e2)
# Values of all series that are segmented at a time, and pairs of values that are held at a time.
BLOCK_CELLS = 1 << 16
PAIR_CELLS = 1 << 20


def median_squared_gap(values: np.ndarray) -> float:
    """Median of all pairwise squared differences, in memory linear in their number.

    The gaps of a rank are found by halving the range of values: how many gaps are at most
    some width follows from one search per value.
    """
    x = np.sort(values)
    n = len(x)
    pairs = n * (n - 1) // 2
    index = np.arange(n)

    def below(gap: float) -> int:
        return int((np.searchsorted(x, x + gap, side="right") - index - 1).sum())

    def ranked(rank: int) -> float:
        lo, hi = 0.0, float(x[-1] - x[0])
        if below(lo) >= rank:
            return lo
        while (mid := (lo + hi) / 2) not in (lo, hi):
            lo, hi = (lo, mid) if below(mid) >= rank else (mid, hi)
        return hi

    if not pairs:
        return 0.0
    low = ranked((pairs + 1) // 2)
    high = low if pairs % 2 else ranked(pairs // 2 + 1)
    return (low**2 + high**2) / 2


def median_squared_gaps(rows: np.ndarray) -> np.ndarray:
    """``median_squared_gap`` of each row; short rows compare all pairs, a bounded block at a time."""
    n = rows.shape[1]
    pairs = n * (n - 1) // 2
    if not pairs or pairs > PAIR_CELLS:
        return np.array([median_squared_gap(r) for r in rows])
    i, j = np.triu_indices(n, 1)
    ranks = [(pairs - 1) // 2, pairs // 2]
    found = []
    for part in np.array_split(rows, -(-len(rows) * pairs // PAIR_CELLS)):
        low, high = np.partition(np.abs(part[:, i] - part[:, j]), ranks, axis=1)[:, ranks].T
        found.append((low**2 + high**2) / 2)
    return np.concatenate(found)


def _last_breakpoints(values: np.ndarray, sizes: np.ndarray, cfg: EngineConfig) -> np.ndarray:
    """Last change, 0 for none, of each row's first ``sizes`` values; ``sizes`` fall.

    Changes of the optimal penalised segmentation (PELT; Killick et al. 2012). The segment cost
    is the within-segment scatter under a Gaussian kernel whose width follows the median heuristic
    (Arlot et al. 2019). Segment ends lie on a grid. The kernel sums of all open segments grow
    block by block, so memory stays linear in the length of the series.
    """
    rows, longest = values.shape
    spread = np.concatenate([median_squared_gaps(values[sizes == n, :n]) for n in -np.unique(-sizes)])
    gamma = 1.0 / np.where(spread == 0.0, 1.0, spread)[:, None, None]
    grid, smallest = cfg.cp_grid, cfg.cp_min_size
    ends = [t for t in range(grid, longest, grid) if t >= smallest] + [longest]
    places = np.arange(0, longest, grid)

    best = np.full((rows, len(places)), np.inf)  # cost of the best segmentation up to a place
    best[:, 0] = 0.0
    is_start = np.zeros(best.shape, dtype=bool)
    kernel_sum = np.zeros(values.shape)  # kernel_sum[:, s]: kernel total over values[:, s:done]
    last = np.zeros(rows, dtype=int)
    done = 0
    for end in ends:
        live = int((sizes > done).sum())
        x, ended = values[:live, :end], np.minimum(sizes[:live], end)
        inside = np.arange(done, end) < ended[:, None]
        distance = np.clip(gamma[:live] * (x[:, :, None] - x[:, None, done:]) ** 2, *DISTANCE_RANGE)
        kernel = np.exp(-distance)
        kernel[:, np.arange(done, end), np.arange(end - done)] = 1.0
        kernel *= inside[:, None, :]
        kernel[:, done:] *= inside[:, :, None]
        # Pairs (earlier, new) count twice, pairs inside the new block once per order.
        tail = np.cumsum(kernel.sum(axis=2)[:, ::-1], axis=1)[:, ::-1]
        fresh = tail[:, done : done + 1]
        sums = kernel_sum[:live]
        sums[:, :done] += 2.0 * (tail[:, :done] - fresh) + fresh
        for s in range(done, end):
            sums[:, s] = kernel[:, s:, s - done :].sum(axis=(1, 2))
        done = end

        newest = (ended - smallest) // grid
        row = np.flatnonzero(newest >= 0)
        is_start[row, newest[row]] |= np.isfinite(best[row, newest[row]])
        at = places[places < end]
        open_ = is_start[:live, : len(at)]
        length = np.maximum(ended[:, None] - at, 1)
        cost = length - sums[:, at] / length
        reach = np.where(open_, best[:live, : len(at)] + cost, np.inf)
        pick = reach.argmin(axis=1)
        total = reach[np.arange(live), pick] + cfg.cp_penalty
        final = sizes[:live] <= end
        last[:live][final] = at[pick[final]]
        if end < longest:
            best[:live, end // grid] = np.where(final, np.inf, total)
        open_ &= reach <= total[:, None]
    return last


def last_breakpoints(series: list[np.ndarray], cfg: EngineConfig) -> list[int | None]:
    """Last change of each series, None for none; series of like length are segmented together."""
    found: list[int | None] = [None] * len(series)
    order = sorted(range(len(series)), key=lambda k: -len(series[k]))
    while order:
        width = len(series[order[0]])
        some = order[: max(1, BLOCK_CELLS // max(width, 1))]
        order = order[len(some) :]
        values = np.zeros((len(some), width))
        for row, k in zip(values, some):
            row[: len(series[k])] = series[k]
        sizes = np.array([len(series[k]) for k in some])
        for k, at in zip(some, _last_breakpoints(values, sizes, cfg)):
            found[k] = int(at) or None
    return found


def last_breakpoint(values: np.ndarray, cfg: EngineConfig) -> int | None:
    return last_breakpoints([values], cfg)[0]


def change_indexes(series: list[np.ndarray | None], cfg: EngineConfig) -> list[int | None]:
    """Accepted change of each user's series, away from both of its ends; None without one."""
    found: list[int | None] = [None] * len(series)
    long = [k for k, v in enumerate(series) if v is not None and len(v) >= cfg.cp_min_days]
    margin = cfg.cp_min_days // 2
    for k, at in zip(long, last_breakpoints([np.asarray(series[k], dtype=float) for k in long], cfg)):
        if at is not None and margin < at < len(series[k]) - margin:
            found[k] = at
    return found


def change_index(values: np.ndarray, cfg: EngineConfig) -> int | None:
    return change_indexes([values], cfg)[0]


def user_series(rollup: DataFrame) -> DataFrame:
    """One row per user: active days in order and the seconds of each.

    An array holds at most one entry per calendar day.
    """
    pairs = "array_sort(collect_list(struct(log_date, day_secs)))"
    return (
        rollup.groupBy("msno")
        .agg(*columns({"series": pairs}))
        .selectExpr("msno", "series.log_date AS days", "series.day_secs AS secs")
    )


def with_breakpoints(series: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Add ``cp_idx``: the change index, NULL when there is none.

    Histories below the minimum are not sent to Python.
    """

    @F.pandas_udf("int")
    def locate(batch: pd.Series) -> pd.Series:
        return pd.Series(change_indexes(list(batch), cfg), dtype="Int32")

    long_enough = F.expr(f"CASE WHEN size(secs) >= {cfg.cp_min_days} THEN secs END")
    return series.withColumn("cp_idx", locate(long_enough))


def change_point_stats(series: DataFrame, *keep: str) -> DataFrame:
    """Date, slope, means and relative change around each user's ``cp_idx``.

    Works on the arrays ``days`` and ``secs``: no join and no further shuffle. The slope
    is least squares on 0..n-1, whose mean and scatter have closed forms. ``keep`` columns
    are passed on.
    """
    halves = series.selectExpr(
        "msno",
        *keep,
        "days",
        "cp_idx",
        "slice(secs, 1, cp_idx) AS pre",
        "slice(secs, cp_idx + 1, size(secs)) AS post",
    )
    total = "aggregate({}, 0D, (acc, y) -> acc + y)"
    sums = halves.selectExpr(
        "msno",
        *keep,
        "days",
        "cp_idx",
        "CAST(size(post) AS DOUBLE) AS n",
        f"{total.format('pre')} AS sum_pre",
        f"{total.format('post')} AS sum_post",
        f"{total.format('transform(post, (y, i) -> i * y)')} AS sum_xy",
    )
    stats = sums.selectExpr(
        "msno",
        *keep,
        "cp_idx IS NOT NULL AS change_point_detected",
        "days[cp_idx] AS change_point_date",
        "datediff(element_at(days, -1), days[cp_idx]) AS days_since_change_point",
        """CASE WHEN cp_idx IS NULL THEN NULL WHEN n < 3 THEN 0D
                ELSE (sum_xy - (n - 1D) / 2D * sum_post) / (n * (n * n - 1D) / 12D)
           END AS usage_slope_post_change""",
        "sum_pre / nullif(cp_idx, 0) AS pre_change_daily_mean",
        "sum_post / nullif(n, 0D) AS post_change_daily_mean",
    )
    return stats.selectExpr(
        "*",
        """(post_change_daily_mean - pre_change_daily_mean) / (pre_change_daily_mean + 1e-9D)
           AS pct_usage_change""",
    )


def detect_change_points(rollup: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per user of the log; NULL statistics where nothing changed."""
    return change_point_stats(with_breakpoints(user_series(rollup), cfg))


def detected_share(change_points: DataFrame) -> DataFrame:
    found = "count_if(change_point_detected)"
    return change_points.agg(
        *columns(
            {
                "detected_users": found,
                "users": "count(*)",
                "detected_share": f"try_divide({found}, count(*))",
            }
        )
    )
