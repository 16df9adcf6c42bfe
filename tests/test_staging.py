from datetime import date

import pytest

from staywise.config import EngineConfig
from staywise.operators import staging
from staywise.sources.schemas import MEMBERS, TRANSACTIONS, USER_LOGS

CFG = EngineConfig()


def column(frame, name, *order):
    return [r[name] for r in frame.orderBy(*order).collect()]


def test_member_dates_and_ages(spark):
    ages = [0, 9, 10, 19, 20, 50, 75, 76, 2000, None]
    days = [20170315, 20170231, 0, None, 20170331, 20170330, 20170301, 20170228, 1, 99999999]
    rows = [(f"{i}", 1, a, "male" if i % 2 else "x", 1, d) for i, (a, d) in enumerate(zip(ages, days))]
    out = staging.stage_members(spark.createDataFrame(rows, MEMBERS), CFG)
    assert column(out, "age_bucket", "msno") == [
        "unknown", "unknown", "10-19", "10-19", "20-29", "50+", "50+", "unknown", "unknown", "unknown",
    ]
    found = column(out, "registration_date", "msno")
    assert found[:5] == [date(2017, 3, 15), None, None, None, date(2017, 3, 31)]
    assert found[8:] == [None, None]
    assert column(out, "tenure_days", "msno")[:5] == [16, None, None, None, 0]
    assert column(out, "gender_male_flag", "msno")[:2] == [None, 1]


def test_null_keys_are_dropped(spark):
    rows = [(None, 1, 20, "male", 1, 20170101), ("a", 1, 20, "male", 1, 20170101)]
    assert staging.stage_members(spark.createDataFrame(rows, MEMBERS), CFG).count() == 1


def test_log_ratios(spark):
    rows = [
        ("a", 20170301, None, None, None, None, None, None, None),
        ("b", 20170301, 1, 1, 0, 0, 1, 3, 3600.0),
        ("c", 20170231, 1, 1, 0, 0, 1, 3, 3600.0),
    ]
    out = staging.stage_user_logs(spark.createDataFrame(rows, USER_LOGS)).orderBy("msno").collect()
    assert [r["msno"] for r in out] == ["a", "b"]
    assert (out[0]["completion_rate"], out[0]["skip_rate"], out[0]["total_tracks"]) == (None, None, 0)
    assert (out[1]["completion_rate"], out[1]["listening_hours"]) == (0.3333, 1.0)


def payments(spark, prices, days, paid=None):
    rows = [
        ("u", 1, 30, float(p), float(p if paid is None else paid[i]), 1, d, d, 0)
        for i, (p, d) in enumerate(zip(prices, days))
    ]
    return spark.createDataFrame(rows, TRANSACTIONS)


def test_payment_flags(spark):
    raw = payments(spark, [100, 0, 100], [20170101, 20170102, 20170103], paid=[0, 0, 75])
    out = staging.stage_transactions(staging.stage_payments(raw))
    assert column(out, "payment_failure_flag", "transaction_date") == [1, 0, 0]
    assert column(out, "discount_rate", "transaction_date") == [1.0, 0.0, 0.25]


def test_downgrade_and_undated_rows_last(spark):
    raw = payments(spark, [100, 100, 80, 120, 70], [20170101, 20170102, 20170103, 20170104, 20170231])
    out = staging.stage_transactions(staging.stage_payments(raw))
    by_day = {r["transaction_date"]: r["plan_downgrade_flag"] for r in out.collect()}
    assert by_day[None] == 1
    assert [by_day[date(2017, 1, d)] for d in (1, 2, 3, 4)] == [0, 0, 1, 0]


def test_crowded_key_gives_the_same_lag(spark):
    """One user holds most rows, many of them copies or undated; the order is that of one window."""
    rows = []
    for i in range(400):
        user = "hot" if i % 4 else f"u{i % 12}"
        price, day = float(i * 7919 % 13), 20170101 + i % 5
        rows.append((user, 1, 30, price, price, 1, day if i % 11 else 20170231, day, 0))
    rows += [("hot", 1, 30, 5.0, 5.0, 1, 20170102, 20170102, 0)] * 100
    raw = spark.createDataFrame(rows, TRANSACTIONS)
    payments = staging.stage_payments(raw)
    plain = payments.selectExpr(
        "*",
        """lag(plan_list_price) OVER (PARTITION BY msno ORDER BY transaction_date IS NULL,
           transaction_date, txn_key) AS prev_plan_list_price""",
    )
    split = staging.stage_transactions(payments)
    assert split.columns == [*plain.columns, "plan_downgrade_flag"]
    assert sorted(map(repr, split.drop("plan_downgrade_flag").collect())) == sorted(map(repr, plain.collect()))
