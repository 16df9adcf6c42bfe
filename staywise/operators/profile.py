"""Descriptive statistics of the feature mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staywise.functions.columns import columns
from staywise.operators.drift import bin_of, feature_ranges, long_values
from staywise.operators.ranking import exact_quantiles

# Key drivers looked at when exploring the mart.
PROFILE_FEATURES = (
    "usage_decay_30d",
    "sessions_last_30d",
    "login_gap_days_avg",
    "ticket_count_90d",
    "payment_failure_count_90d",
)


def churn_rate(mart: DataFrame) -> DataFrame:
    return mart.agg(
        *columns({"churn_rate": "avg(is_churn)", "labelled_users": "count(is_churn)"})
    )


def target_distribution(mart: DataFrame) -> DataFrame:
    classes = mart.filter("is_churn IS NOT NULL").groupBy("is_churn")
    # The window runs over the two class rows.
    return classes.agg(*columns({"users": "count(*)"})).selectExpr(
        "*", "users / sum(users) OVER () AS proportion"
    )


def feature_summary(mart: DataFrame, features: tuple[str, ...] = PROFILE_FEATURES) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per feature."""
    values = long_values(mart, list(features))
    moments = values.groupBy("feature").agg(
        *columns(
            {
                "count": "count(value)",
                "mean": "avg(value)",
                "std": "stddev_samp(value)",
                "min": "min(value)",
                "max": "max(value)",
            }
        )
    )
    quartiles = exact_quantiles(values, "feature", "value", [0.25, 0.5, 0.75])
    return moments.join(quartiles, "feature").withColumnsRenamed(
        {"q0": "p25", "q1": "p50", "q2": "p75"}
    )


def feature_histogram(
    mart: DataFrame, features: tuple[str, ...] = PROFILE_FEATURES, bins: int = 20
) -> DataFrame:
    """Counts per feature, class and equal-width bin: the data behind a density plot."""
    labelled = mart.filter("is_churn IS NOT NULL")
    ranges = F.broadcast(feature_ranges(labelled, list(features)))
    counted = ("feature", "is_churn", "bin", "lo", "hi")
    return (
        long_values(labelled, list(features), "is_churn")
        .join(ranges, "feature")
        .selectExpr("*", f"{bin_of(bins)} AS bin")
        .groupBy(*counted)
        .agg(*columns({"users": "count(*)"}))
        .selectExpr(
            *counted[:3], f"lo + bin * ((hi - lo) / {bins}D) AS bin_start", "users"
        )
    )


def churn_by_tier(mart: DataFrame) -> DataFrame:
    tiers = mart.filter("is_churn IS NOT NULL").groupBy("risk_tier")
    return tiers.agg(*columns({"churn_rate": "avg(is_churn)", "users": "count(*)"})).orderBy(
        F.desc("churn_rate")
    )
