"""Daily roll-up, streaks of active days ("sessions") and login cadence.

Everything starts from the daily roll-up: its map-side partial aggregation collapses a
hot user before the shuffle, and afterwards a user has at most one row per calendar day,
which bounds every per-user window below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from staywise.config import EngineConfig
from staywise.functions.columns import (
    columns,
    day,
    days_ago,
    flag,
    from_units,
    ratio,
    round_to,
    to_units,
)


def daily_rollup(logs: DataFrame) -> DataFrame:
    """One row per user and active day with the sums every later operator needs.

    Four-decimal columns are summed as whole ten-thousandths, so sums and the averages
    taken from them are exact and independent of partitioning.
    """
    sums = {
        "day_secs": "sum(total_secs)",
        "day_tracks": "sum(CAST(total_tracks AS BIGINT))",
        "hours_units": f"sum({to_units('listening_hours', 4)})",
        "log_rows": "count(*)",
        "completion_units": f"sum({to_units('completion_rate', 4)})",
        "skip_units": f"sum({to_units('skip_rate', 4)})",
        "rated_rows": "count(completion_rate)",
    }
    return logs.groupBy("msno", "log_date").agg(*columns(sums))


def daily_activity(rollup: DataFrame) -> DataFrame:
    return rollup.selectExpr(
        "msno",
        "log_date",
        f"{from_units('hours_units', 4)} AS daily_hours",
        "day_tracks AS daily_tracks",
    )


def with_session_ids(rollup: DataFrame) -> DataFrame:
    """Tag each active day with its session: a gap of more than one day starts a new one."""
    starts = flag("prev_log_date IS NULL OR datediff(log_date, prev_log_date) > 1")
    return (
        rollup.selectExpr(
            "*", "lag(log_date) OVER (PARTITION BY msno ORDER BY log_date) AS prev_log_date"
        )
        .selectExpr("*", f"{starts} AS is_session_start")
        .selectExpr(
            "*",
            """sum(is_session_start) OVER (PARTITION BY msno ORDER BY log_date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_id""",
        )
    )


def sessions(rollup: DataFrame) -> DataFrame:
    metrics = {
        "session_start": "min(log_date)",
        "session_end": "max(log_date)",
        "session_length_days": "count(*)",
        "session_total_hours": from_units("sum(hours_units)", 4),
        "session_avg_daily_tracks": ratio("sum(day_tracks)", "count(*)"),
        "session_total_tracks": "sum(day_tracks)",
    }
    return with_session_ids(rollup).groupBy("msno", "session_id").agg(*columns(metrics))


def session_gaps(session_rows: DataFrame) -> DataFrame:
    """Idle days between a session and the one before it; NULL for the first."""
    return session_rows.selectExpr(
        "*",
        """datediff(session_start, lag(session_end) OVER
               (PARTITION BY msno ORDER BY session_id)) AS gap_before_session""",
    )


def _cadence(cfg: EngineConfig) -> dict[str, str]:
    """Login cadence of a user as aggregates over active days (``_days``), the latest one included."""
    idle_now = days_ago(cfg.ref_date, "max(log_date)")
    mean_gap = ratio("sum(gap_before)", "count(gap_before)")
    return {
        "login_days_last_30d": "count_if(age <= 30)",
        "login_days_last_60d": "count_if(age <= 60)",
        "login_gap_days_avg": round_to(f"coalesce({mean_gap}, 0D)", 2),
        "login_gap_days_max": "coalesce(max(gap_before), 0)",
        "login_gap_days_recent": "coalesce(max_by(gap_before, first_day), 0)",
        "login_streak_max": "max(streak)",
        "login_streak_current": f"CASE WHEN {idle_now} <= 3 THEN max_by(streak, log_date) ELSE 0 END",
        "days_since_last_login": idle_now,
    }


def _age(cfg: EngineConfig) -> str:
    return f"{days_ago(cfg.ref_date, 'log_date')} AS age"


def _days(rollup: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Active days with what a session shows on each of them, so that sessions need no rows of their own.

    The days of a session follow each other, so ``streak``, the days since its first one, ends as
    its length. ``gap_before`` and ``first_day`` are those of sessions and set on their first days.
    """
    order = "OVER (PARTITION BY msno ORDER BY log_date"
    gap = "datediff(log_date, prev_log_date)"
    started = f"max(first_day) {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return (
        rollup.selectExpr("*", _age(cfg), f"lag(log_date) {order}) AS prev_log_date")
        .selectExpr(
            "*",
            f"CASE WHEN prev_log_date IS NULL OR {gap} > 1 THEN log_date END AS first_day",
            f"CASE WHEN {gap} > 1 THEN {gap} END AS gap_before",
        )
        .selectExpr("*", f"CAST(datediff(log_date, {started}) + 1 AS BIGINT) AS streak")
    )


def login_frequency(rollup: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Login cadence per user in one pass: windows and aggregate share one exchange."""
    return _days(rollup, cfg).groupBy("msno").agg(*columns(_cadence(cfg)))


# ---- usage decay -----------------------------------------------------------------------


def _window_sums(cfg: EngineConfig) -> dict[str, str]:
    """Additive day-level pieces (over ``age``) from which all usage windows are computed."""

    def total(condition: str, column: str) -> str:
        return f"sum(CASE WHEN {condition} THEN {column} ELSE 0 END)"

    pieces: dict[str, str] = {}
    for length, recent in cfg.windows:
        inside = f"age <= {length}"
        pieces[f"w{length}_days"] = f"count_if({inside})"
        pieces[f"w{length}_hours"] = total(inside, "hours_units")
        pieces[f"w{length}_tracks"] = total(inside, "day_tracks")
        pieces[f"w{length}_rows"] = total(inside, "log_rows")
        for half, lo, hi in (("old", recent + 1, length), ("new", 1, recent)):
            condition = f"age BETWEEN {lo} AND {hi}"
            pieces[f"w{length}_{half}_hours"] = total(condition, "hours_units")
            pieces[f"w{length}_{half}_rows"] = total(condition, "log_rows")
    shortest = f"age <= {cfg.windows[0][0]}"
    pieces["rated_rows_30"] = total(shortest, "rated_rows")
    pieces["completion_30"] = total(shortest, "completion_units")
    pieces["skip_30"] = total(shortest, "skip_units")
    return pieces


def _usage(cfg: EngineConfig) -> dict[str, str]:
    def mean(units: str, rows: str) -> str:
        return ratio(from_units(units, 4), rows)

    out: dict[str, str] = {}
    for length, _ in cfg.windows:
        w = f"w{length}"
        out[f"sessions_last_{length}d"] = f"{w}_days"
        out[f"hours_last_{length}d"] = from_units(f"{w}_hours", 4)
        out[f"tracks_last_{length}d"] = f"{w}_tracks"
        out[f"avg_daily_hours_last_{length}d"] = mean(f"{w}_hours", f"{w}_rows")
    out["completion_rate_avg_30d"] = mean("completion_30", "rated_rows_30")
    out["skip_rate_avg_30d"] = mean("skip_30", "rated_rows_30")
    for length, _ in cfg.windows:
        w = f"w{length}"
        older = mean(f"{w}_old_hours", f"{w}_old_rows")
        recent = mean(f"{w}_new_hours", f"{w}_new_rows")
        out[f"usage_decay_{length}d"] = round_to(ratio(f"({older} - {recent})", older), 4)
    return out


def usage_decay(rollup: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Usage totals, averages and half-window decay over the look-back windows.

    The date filter sits on a grouping column of the roll-up, so Catalyst moves it below
    that aggregate to the log scan.
    """
    longest = cfg.windows[-1][0]
    recent = rollup.filter(f"log_date >= date_sub({day(cfg.ref_date)}, {longest})")
    aged = recent.selectExpr("*", _age(cfg))
    sums = aged.groupBy("msno").agg(*columns(_window_sums(cfg)))
    return sums.select("msno", *columns(_usage(cfg)))


def activity_features(
    rollup: DataFrame, cfg: EngineConfig, with_series: bool = False
) -> DataFrame:
    """Login cadence and usage decay of every user from a single pass over the roll-up.

    Both are aggregates over a user's active days, so the wide feature table scans and shuffles
    the log once instead of once per feature family. Users without activity in the longest window
    have NULL usage columns, as a left join would give. ``with_series`` also carries the user's
    ordered ``days`` and ``secs``, from which the change point is found without another shuffle.
    """
    metrics = {**_cadence(cfg), **_window_sums(cfg)}
    if with_series:
        metrics["series"] = "sort_array(collect_list(struct(log_date, day_secs)))"
    per_user = _days(rollup, cfg).groupBy("msno").agg(*columns(metrics))
    active = f"w{cfg.windows[-1][0]}_days > 0"
    usage = {n: f"CASE WHEN {active} THEN {sql} END" for n, sql in _usage(cfg).items()}
    if with_series:
        usage |= {"days": "series.log_date", "secs": "series.day_secs"}
    return per_user.select("msno", *_cadence(cfg), *columns(usage))
