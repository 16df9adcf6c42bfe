"""Typed, cleaned staging tables from the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staywise.config import EngineConfig
from staywise.functions.columns import (
    clean_text,
    columns,
    day_from_int,
    day_from_text,
    days_ago,
    flag,
    round_to,
)
from staywise.operators.skew import previous_value


# Age buckets of ten years with the last one open.
AGE_BUCKETS = " ".join(
    [*[f"WHEN age < {low + 10} THEN '{low}-{low + 9}'" for low in (10, 20, 30, 40)], "WHEN age >= 50 THEN '50+'"]
)


def stage_members(raw: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Gender flag, plausible age with its bucket, and tenure at the reference date."""
    return (
        raw.filter("msno IS NOT NULL")
        .selectExpr(
            "msno",
            "CASE gender WHEN 'male' THEN 1 WHEN 'female' THEN 0 END AS gender_male_flag",
            "city",
            "registered_via",
            f"{day_from_int('registration_init_time')} AS registration_date",
            "CASE WHEN bd BETWEEN 10 AND 75 THEN bd END AS age",
        )
        .selectExpr(
            "*",
            f"CASE {AGE_BUCKETS} ELSE 'unknown' END AS age_bucket",
            f"{days_ago(cfg.ref_date, 'registration_date')} AS tenure_days",
        )
    )


PLAY_COUNTERS = ("num_25", "num_50", "num_75", "num_985", "num_100")


def stage_user_logs(raw: DataFrame) -> DataFrame:
    """One row per log line with a valid day, plus play totals and play-through rates."""
    share = "CAST({} AS DOUBLE) / nullif(CAST(total_tracks AS DOUBLE), 0D)"
    return (
        raw.filter("msno IS NOT NULL")
        .selectExpr(
            "msno",
            f"{day_from_int('date')} AS log_date",
            *[f"coalesce({c}, 0) AS {c}" for c in (*PLAY_COUNTERS, "num_unq")],
            "coalesce(total_secs, 0D) AS total_secs",
        )
        .filter("log_date IS NOT NULL")
        .selectExpr("*", f"{' + '.join(PLAY_COUNTERS)} AS total_tracks")
        .selectExpr(
            "*",
            f"{round_to('total_secs / 3600D', 4)} AS listening_hours",
            f"CASE WHEN total_tracks > 0 THEN {round_to(share.format('num_100'), 4)} END "
            "AS completion_rate",
            f"CASE WHEN total_tracks > 0 THEN {round_to(share.format('num_25'), 4)} END "
            "AS skip_rate",
        )
    )


def stage_payments(raw: DataFrame) -> DataFrame:
    """Payments with failure flag and discount rate.

    Sources without ``txn_key`` get a hash of the whole row: equal hashes mean equal rows,
    whose order is immaterial.
    """
    if "txn_key" not in raw.columns:
        raw = raw.withColumn("txn_key", F.xxhash64(*[F.col(c) for c in raw.columns]))
    discount = round_to("1D - actual_amount_paid / nullif(CAST(plan_list_price AS DOUBLE), 0D)", 4)
    return (
        raw.filter("msno IS NOT NULL")
        .selectExpr(
            "msno",
            "CAST(txn_key AS BIGINT) AS txn_key",
            "payment_method_id",
            "payment_plan_days",
            "plan_list_price",
            "actual_amount_paid",
            "is_auto_renew",
            "is_cancel",
            f"{day_from_int('transaction_date')} AS transaction_date",
            f"{day_from_int('membership_expire_date')} AS membership_expire_date",
        )
        .selectExpr(
            "*",
            "datediff(membership_expire_date, transaction_date) AS days_until_expiry",
            f"{flag('actual_amount_paid = 0 AND plan_list_price > 0')} AS payment_failure_flag",
            f"CASE WHEN plan_list_price > 0 THEN {discount} ELSE 0D END AS discount_rate",
        )
    )


def stage_transactions(payments: DataFrame) -> DataFrame:
    """Payments with the price before and the downgrade flag.

    A user's payments are ordered by day, undated ones last, and by ``txn_key`` within it.
    """
    with_previous = previous_value(
        payments, "msno", "transaction_date", "txn_key", "plan_list_price", "prev_plan_list_price"
    )
    return with_previous.selectExpr(
        "*", f"{flag('plan_list_price < prev_plan_list_price')} AS plan_downgrade_flag"
    )


def stage_feature_events(raw: DataFrame) -> DataFrame:
    return raw.filter("msno IS NOT NULL AND event_date IS NOT NULL").selectExpr(
        "msno",
        f"{day_from_text('event_date')} AS event_date",
        f"{clean_text('feature_name')} AS feature_name",
        "coalesce(session_duration_sec, 0) AS session_duration_sec",
    )


def stage_support_tickets(raw: DataFrame) -> DataFrame:
    return (
        raw.filter("msno IS NOT NULL AND ticket_date IS NOT NULL")
        .selectExpr(
            "ticket_id",
            "msno",
            f"{day_from_text('ticket_date')} AS ticket_date",
            *[f"{clean_text(c)} AS {c}" for c in ("category", "sentiment", "resolution_status")],
            "time_to_fix_hours",
        )
        .select(
            "*",
            *columns(
                {
                    "is_negative": flag("sentiment = 'negative'"),
                    "is_unresolved": flag("resolution_status = 'unresolved'"),
                    "is_cancellation": flag("category = 'cancellation_inquiry'"),
                }
            ),
        )
    )


def stage_interventions(raw: DataFrame) -> DataFrame:
    return raw.filter("msno IS NOT NULL").selectExpr(
        "msno",
        f"{clean_text('intervention_type')} AS intervention_type",
        f"{day_from_text('intervention_date')} AS intervention_date",
        "coalesce(email_opened, false) AS email_opened",
        "coalesce(email_clicked, false) AS email_clicked",
    )


def stage_outcomes(raw: DataFrame) -> DataFrame:
    return raw.filter("msno IS NOT NULL").selectExpr(
        "msno",
        f"{clean_text('intervention_type')} AS intervention_type",
        *[f"coalesce({c}, false) AS {c}" for c in ("renewed", "was_saved", "observed_churn")],
    )
