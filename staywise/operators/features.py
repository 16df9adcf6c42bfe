"""Per-user support, payment, adoption and campaign features, and the wide master table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from staywise.config import EngineConfig
from staywise.functions.columns import (
    columns,
    day,
    day_from_int,
    days_ago,
    flag,
    from_units,
    ratio,
    round_to,
    to_units,
)


def support_signals(tickets: DataFrame, cfg: EngineConfig) -> DataFrame:
    age = days_ago(cfg.ref_date, "ticket_date")
    last_30, last_90 = f"count_if({age} <= 30)", f"count_if({age} <= 90)"
    negative_share = ratio("sum(is_negative)", "count(is_negative)")
    metrics = {
        "ticket_count_30d": last_30,
        "ticket_count_90d": last_90,
        "ticket_count_all": "count(*)",
        "ticket_velocity": round_to(ratio(f"{last_30} * 3D", last_90), 4),
        "pct_negative_sentiment": round_to(negative_share, 4),
        "negative_ticket_count": "count_if(is_negative = 1)",
        "unresolved_ticket_count": "count_if(is_unresolved = 1)",
        "avg_time_to_fix_hours": round_to("avg(time_to_fix_hours)", 2),
        "has_cancellation_inquiry": "max(is_cancellation)",
        "cancellation_inquiry_30d": f"max({flag(f'is_cancellation = 1 AND {age} <= 30')})",
        "billing_ticket_count": "count_if(category = 'billing')",
        "billing_ticket_30d": f"count_if(category = 'billing' AND {age} <= 30)",
    }
    return tickets.groupBy("msno").agg(*columns(metrics))


# The user's newest dated payment as one struct-valued aggregate (no self-join).
LATEST_PAYMENT = """max(struct(transaction_date, txn_key, membership_expire_date,
                               is_auto_renew, is_cancel, plan_list_price))"""


def latest_transaction(transactions: DataFrame) -> DataFrame:
    return (
        transactions.groupBy("msno")
        .agg(*columns({"last": LATEST_PAYMENT}))
        .selectExpr(
            "msno",
            "last.transaction_date AS last_txn_date",
            "last.membership_expire_date AS membership_expire_date",
            "last.is_auto_renew AS auto_renew_flag",
            "last.is_cancel AS is_cancel_flag",
            "last.plan_list_price AS current_plan_price",
        )
    )


def transaction_signals(transactions: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Payment features per user, from one pass over the payments.

    They are first reduced to (user, payment method, price), which spreads a user with a
    third of all payments; what is left per user is as small as the price list, so the
    distinct counts are sizes of sets.
    """
    recent = f"{days_ago(cfg.ref_date, 'transaction_date')} <= 90"
    paid = to_units(f"CASE WHEN {recent} THEN actual_amount_paid ELSE 0D END", 4)
    parts = {
        "last": LATEST_PAYMENT,
        "downgraded": "max(plan_downgrade_flag)",
        "failures": f"count_if(payment_failure_flag = 1 AND {recent})",
        "discount": f"sum({to_units('discount_rate', 4)})",
        "discounts": "count(discount_rate)",
        "discounted": f"max({flag(f'discount_rate > 0 AND {recent}')})",
        "paid": f"sum({paid})",
        "cancelled": "count_if(is_cancel = 1)",
    }
    discount_sum = from_units("sum(discount)", 4)
    metrics = {
        "last": "max(last)",
        "plan_downgrade_flag": "max(downgraded)",
        "payment_failure_count_90d": "sum(failures)",
        "avg_discount_rate": round_to(ratio(discount_sum, "sum(discounts)"), 4),
        "received_discount_90d": "max(discounted)",
        "total_paid_90d": from_units("sum(paid)", 4),
        "cancellation_count": "sum(cancelled)",
        "payment_method_changes": "CAST(size(collect_set(payment_method_id)) AS BIGINT)",
        "distinct_plan_count": "CAST(size(collect_set(plan_list_price)) AS BIGINT)",
    }
    return (
        transactions.groupBy("msno", "payment_method_id", "plan_list_price")
        .agg(*columns(parts))
        .groupBy("msno")
        .agg(*columns(metrics))
        .selectExpr(
            "msno",
            "last.is_auto_renew AS auto_renew_flag",
            "last.is_cancel AS is_cancel_flag",
            f"{days_ago(cfg.ref_date, 'last.transaction_date')} AS days_since_last_txn",
            f"datediff(last.membership_expire_date, {day(cfg.ref_date)}) "
            "AS membership_expire_days",
            *[m for m in metrics if m != "last"],
        )
    )


def feature_adoption(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Breadth, recency and depth of product-feature use.

    Grouping by (user, feature) first makes the distinct counts plain counts: a feature
    was used in the window exactly when its smallest age is inside the window.
    """
    age = days_ago(cfg.ref_date, "event_date")
    per_feature = events.groupBy("msno", "feature_name").agg(
        *columns(
            {
                "newest": f"min({age})",
                "newest_past": f"min(CASE WHEN {age} >= 0 THEN {age} END)",
                "secs_30": f"sum(CASE WHEN {age} <= 30 "
                "THEN CAST(session_duration_sec AS BIGINT) ELSE 0 END)",
                "events_30": f"count_if({age} <= 30)",
            }
        )
    )
    used_30 = "count_if(newest <= 30 AND feature_name IS NOT NULL)"
    metrics = {
        "unique_features_used_30d": used_30,
        "unique_features_used_all": "count(feature_name)",
        "feature_diversity_score": round_to(f"{used_30} / {cfg.product_feature_count}D", 4),
        "days_since_last_feature_use": "min(newest_past)",
        "avg_session_duration_30d": ratio("sum(secs_30)", "sum(events_30)"),
        "total_session_sec_30d": "sum(secs_30)",
    }
    return per_feature.groupBy("msno").agg(*columns(metrics))


def intervention_engagement(interventions: DataFrame) -> DataFrame:
    """Latest intervention of each user, so the master table keeps one row per user."""
    newest = "max(struct(intervention_date, intervention_type, email_opened, email_clicked))"
    return (
        interventions.groupBy("msno")
        .agg(*columns({"last": newest}))
        .selectExpr(
            "msno",
            "last.intervention_type AS last_intervention_type",
            "last.email_opened AS email_opened",
            "last.email_clicked AS email_clicked",
        )
    )


def activity_stats(raw_logs: DataFrame) -> DataFrame:
    """Mean, spread and span of a user's activity, straight from the raw log."""
    log_day = day_from_int("date")
    metrics = {
        "total_seconds_mean": "avg(total_secs)",
        "total_seconds_std": "coalesce(stddev_samp(total_secs), 50D)",
        "num_25_mean": "avg(num_25)",
        "active_days": f"count({log_day})",
        "first_log": f"min({log_day})",
        "last_log": f"max({log_day})",
    }
    return (
        raw_logs.groupBy("msno")
        .agg(*columns(metrics))
        .selectExpr("*", "greatest(datediff(last_log, first_log), 1) AS tenure_days")
    )


def last_transaction_date(raw_transactions: DataFrame) -> DataFrame:
    newest = f"max({day_from_int('transaction_date')})"
    return raw_transactions.groupBy("msno").agg(*columns({"last_transaction_date": newest}))


# Defaults of the wide table for users without rows in a feature family;
# None keeps the column as it is.
MASTER_DEFAULTS = {
    "sessions_last_30d": "0",
    "sessions_last_60d": "0",
    "sessions_last_90d": "0",
    "hours_last_30d": "0D",
    "avg_session_duration_30d": "0D",
    "usage_decay_30d": None,
    "usage_decay_60d": None,
    "usage_decay_90d": None,
    "completion_rate_avg_30d": "0D",
    "skip_rate_avg_30d": "0D",
    "login_days_last_30d": "0",
    "login_days_last_60d": "0",
    "login_gap_days_avg": "0D",
    "login_gap_days_max": "0",
    "login_gap_days_recent": "0",
    "login_streak_max": "0",
    "login_streak_current": "0",
    "days_since_last_login": "999",
    "ticket_count_30d": "0",
    "ticket_count_90d": "0",
    "ticket_velocity": "0D",
    "pct_negative_sentiment": "0D",
    "unresolved_ticket_count": "0",
    "has_cancellation_inquiry": "0",
    "cancellation_inquiry_30d": "0",
    "billing_ticket_count": "0",
    "auto_renew_flag": "0",
    "is_cancel_flag": "0",
    "plan_downgrade_flag": "0",
    "payment_failure_count_90d": "0",
    "days_since_last_txn": "999",
    "membership_expire_days": "0",
    "avg_discount_rate": "0D",
    "payment_method_changes": "1",
    "total_paid_90d": "0D",
    "cancellation_count": "0",
    "unique_features_used_30d": "0",
    "feature_diversity_score": "0D",
    "days_since_last_feature_use": "999",
    "change_point_detected": "false",
    "change_point_date": None,
    "days_since_change_point": "999",
    "usage_slope_post_change": "0D",
    "pct_usage_change": "0D",
    "last_intervention_type": None,
    "email_opened": "false",
    "email_clicked": "false",
}


def feature_master(
    members: DataFrame,
    labels: DataFrame,
    activity: DataFrame,
    support: DataFrame,
    payments: DataFrame,
    adoption: DataFrame,
    change_points: DataFrame | None,
    engagement: DataFrame,
    labelled_only: bool = True,
) -> DataFrame:
    """Wide per-user feature table.

    ``change_points`` is None when ``activity`` already carries the change-point columns.
    Every input is already one row per user and hash-partitioned by ``msno``, so the
    chain of left joins adds no exchange for them. ``labelled_only=False`` keeps members
    without a label for scoring.
    """
    # Daily listening hours go by this name in the wide table; the adoption table's
    # per-event seconds of the same name are not part of it.
    activity = activity.withColumnRenamed("avg_daily_hours_last_30d", "avg_session_duration_30d")
    adoption = adoption.drop("avg_session_duration_30d")

    how = "inner" if labelled_only else "left"
    wide = members.join(labels.select("msno", "is_churn"), "msno", how)
    for part in (activity, support, payments, adoption, change_points, engagement):
        if part is not None:
            wide = wide.join(part, "msno", "left")
    return wide.selectExpr(
        "msno",
        "is_churn",
        "gender_male_flag",
        "city AS city_encoded",
        "registered_via",
        "age",
        "age_bucket AS age_bucket_encoded",
        "tenure_days",
        *[n if v is None else f"coalesce({n}, {v}) AS {n}" for n, v in MASTER_DEFAULTS.items()],
    )
