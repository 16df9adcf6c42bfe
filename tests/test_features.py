from datetime import date, timedelta
from functools import reduce

import pytest
from pyspark.sql import DataFrame, functions as F

from staywise.config import EngineConfig
from staywise.operators import features, marts, sessions, staging
from staywise.sources.schemas import SUPPORT_TICKETS, USER_LOGS

REF = date(2017, 3, 31)


def log_rows(spark, days, user="u", secs=3600.0):
    rows = [
        (user, int(d.strftime("%Y%m%d")), 1, 0, 0, 0, 1, 2, secs if isinstance(secs, float) else secs[i])
        for i, d in enumerate(days)
    ]
    return sessions.daily_rollup(staging.stage_user_logs(spark.createDataFrame(rows, USER_LOGS)))


def march(*days):
    return [date(2017, 3, d) for d in days]


def test_sessions(spark):
    out = sessions.sessions(log_rows(spark, march(1, 2, 3, 5, 6, 10))).orderBy("session_id").collect()
    assert [r["session_length_days"] for r in out] == [3, 2, 1]
    assert [r["session_start"].day for r in out] == [1, 5, 10]
    assert [r["session_avg_daily_tracks"] for r in out] == [2.0, 2.0, 2.0]


def test_session_days_cover_all_active_days(spark):
    rollup = log_rows(spark, march(1, 1, 2, 9, 9, 20))
    days = sessions.sessions(rollup).agg({"session_length_days": "sum"}).first()[0]
    assert days == rollup.count() == 4


@pytest.mark.parametrize("ref_day, streak", [(12, 1), (14, 0)])
def test_cadence(spark, ref_day, streak):
    cfg = EngineConfig(ref_date=date(2017, 3, ref_day))
    row = sessions.login_frequency(log_rows(spark, march(1, 2, 3, 5, 6, 10)), cfg).first()
    assert (row["login_gap_days_avg"], row["login_gap_days_max"]) == (3.0, 4)
    assert (row["login_gap_days_recent"], row["login_streak_max"]) == (4, 3)
    assert row["login_streak_current"] == streak
    assert row["days_since_last_login"] == ref_day - 10


def test_usage_windows_include_the_31st_day_and_the_future(spark):
    days = [REF - timedelta(days=d) for d in (-1, 0, 1, 15, 16, 30, 31)]
    cfg = EngineConfig(ref_date=REF)
    hours = [3600.0, 3600.0, 3600.0, 3600.0, 7200.0, 7200.0, 3600.0]
    row = sessions.usage_decay(log_rows(spark, days, secs=hours), cfg).first()
    assert row["sessions_last_30d"] == 6
    assert row["usage_decay_30d"] == 0.5  # (2 - 1) / 2, days outside 1..30 left out
    assert row["usage_decay_90d"] is None  # no day in the older half


def test_one_pass_equals_separate_features(spark):
    cfg = EngineConfig(ref_date=REF)
    days = [REF - timedelta(days=d * d % 140) for d in range(25)]
    rollup = log_rows(spark, days).unionByName(
        log_rows(spark, [REF - timedelta(days=200 + d) for d in range(3)], user="old")
    )
    fused = sessions.activity_features(rollup, cfg)
    apart = sessions.login_frequency(rollup, cfg).join(
        sessions.usage_decay(rollup, cfg), "msno", "left"
    )
    assert sessions.activity_features(rollup, cfg, with_series=True).drop("days", "secs").exceptAll(fused).isEmpty()
    assert sorted(map(repr, fused.collect())) == sorted(map(repr, apart.select(fused.columns).collect()))


def test_activity_is_one_aggregate_over_days(spark):
    """Cadence is that of the sessions, which take no rows and no aggregate of their own."""
    cfg = EngineConfig(ref_date=REF)
    days = {"a": (0, 1, 2, 9, 12, 13), "b": (3, 4), "c": (50,), "d": (-1, 0, 2, 5, 6, 7, 8, 30)}
    rollup = reduce(DataFrame.unionByName, [log_rows(spark, [REF - timedelta(days=d) for d in n], u) for u, n in days.items()])
    rows = sessions.session_gaps(sessions.sessions(rollup)).groupBy("msno").agg(
        F.max("session_length_days"), F.sum("gap_before_session"), F.max_by("gap_before_session", "session_id")
    )
    found = sessions.activity_features(rollup, cfg, with_series=True)
    assert {r[0]: (r[1], r[2] or 0, r[3] or 0) for r in rows.collect()} == {
        "a": (3, 10, 7), "b": (2, 0, 0), "c": (1, 0, 0), "d": (4, 27, 2),
    }
    kept = ("login_streak_max", "login_gap_days_avg", "login_gap_days_recent", "login_streak_current")
    assert {r[0]: tuple(r)[1:] for r in found.select("msno", *kept).collect()} == {
        "a": (3, 5.0, 7, 3), "b": (2, 0.0, 0, 2), "c": (1, 0.0, 0, 0), "d": (4, 9.0, 2, 2),
    }
    plan = sessions.activity_features(log_rows(spark, march(1, 2)), cfg, with_series=True)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2


def test_ticket_velocity(spark):
    def tickets(user, ages):
        return [
            (i, user, str(REF - timedelta(days=a)), " Billing", "negative", "resolved", None)
            for i, a in enumerate(ages)
        ]

    raw = spark.createDataFrame(tickets("a", [1, 30, 60]) + tickets("b", [91]), SUPPORT_TICKETS)
    out = features.support_signals(staging.stage_support_tickets(raw), EngineConfig(ref_date=REF))
    rows = {r["msno"]: r for r in out.collect()}
    assert rows["a"]["ticket_velocity"] == 2.0
    assert rows["b"]["ticket_velocity"] is None
    assert rows["a"]["billing_ticket_count"] == 3


def test_clipping(spark):
    rows = spark.createDataFrame([(-5.0, 999), (None, 3), (3.0, 180)], "x double, d int")
    out = rows.selectExpr(f"{marts.clip_decay('x')} AS x", f"{marts.cap_days('d')} AS d").collect()
    assert [tuple(r) for r in out] == [(-2.0, 180), (0.0, 3), (2.0, 180)]


def test_recently_inactive_cohort_needs_no_session_but_a_recent_login(spark):
    rows = spark.createDataFrame(
        [(0, 10), (0, 31), (1, 10), (10, 1), (20, 1)], "sessions_last_30d int, days_since_last_login int"
    ).selectExpr("*", "0D AS decay")
    out = rows.selectExpr(f"{marts.behavioral_cohort('decay')} AS c").collect()
    assert [r["c"] for r in out] == ["recently_inactive", "dormant", "casual", "regular", "power_user"]
