"""Model-ready marts: clipping, encoding, cohorts, risk tiers and treatment results."""

from __future__ import annotations

from pyspark.sql import DataFrame

from staywise.config import TREATMENT_CODES, EngineConfig
from staywise.functions.columns import columns

# Ordinal codes of the age buckets; unknown is 0.
AGE_CODES = {"10-19": 1, "20-29": 2, "30-39": 3, "40-49": 4, "50+": 5}


def code_of(column: str, codes: dict[str, int]) -> str:
    """Integer code of a label, 0 when it is unknown or NULL."""
    cases = " ".join(f"WHEN '{label}' THEN {code}" for label, code in codes.items())
    return f"CASE {column} {cases} ELSE 0 END"


def clip_decay(column: str) -> str:
    return f"greatest(-2D, least(2D, coalesce({column}, 0D)))"


def cap_days(column: str) -> str:
    return f"least(180, {column})"


# Limits and names of cohorts and tiers, in the order they are tested.
def behavioral_cohort(decay: str) -> str:
    return f"""CASE WHEN sessions_last_30d >= 20 AND {decay} > -0.2D THEN 'power_user'
                    WHEN sessions_last_30d >= 10 THEN 'regular'
                    WHEN sessions_last_30d >= 1 THEN 'casual'
                    WHEN days_since_last_login <= 30 THEN 'recently_inactive'
                    ELSE 'dormant' END"""


def risk_tier(decay: str) -> str:
    return f"""CASE WHEN {decay} > 0.3D AND ticket_count_30d >= 2 THEN 'critical'
                    WHEN {decay} > 0.2D OR has_cancellation_inquiry = 1 THEN 'high'
                    WHEN sessions_last_30d < 5 AND days_since_last_login > 14 THEN 'medium'
                    ELSE 'low' END"""


# Columns of the churn mart in order.
CHURN_MART_COLUMNS = (
    "msno", "is_churn", "usage_decay_30d", "usage_decay_60d", "usage_decay_90d",
    "sessions_last_30d", "sessions_last_60d", "sessions_last_90d",
    "avg_session_duration_30d", "completion_rate_avg_30d", "skip_rate_avg_30d",
    "login_days_last_30d", "login_gap_days_avg", "login_gap_days_max", "login_streak_max",
    "login_streak_current", "days_since_last_login", "ticket_count_30d", "ticket_count_90d",
    "ticket_velocity", "pct_negative_sentiment", "unresolved_ticket_count",
    "has_cancellation_inquiry", "cancellation_inquiry_30d", "auto_renew_flag",
    "plan_downgrade_flag", "payment_failure_count_90d", "days_since_last_txn",
    "membership_expire_days", "avg_discount_rate", "cancellation_count",
    "unique_features_used_30d", "feature_diversity_score", "days_since_last_feature_use",
    "change_point_detected", "days_since_change_point", "usage_slope_post_change",
    "pct_usage_change", "gender_male_flag", "city_encoded", "age_bucket_encoded",
    "tenure_days", "behavioral_cohort", "risk_tier", "split",
)


def churn_mart(master: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Clipped and encoded features with cohort, tier and split.

    Labelled users form the train split; the score split is the whole mart. Cohort and
    tier look at the recency before it is capped.
    """
    decay = clip_decay("usage_decay_30d")
    shaped = {
        **{f"usage_decay_{n}d": clip_decay(f"usage_decay_{n}d") for n, _ in cfg.windows},
        **{
            c: cap_days(c)
            for c in ("login_gap_days_max", "days_since_last_login", "days_since_last_txn")
        },
        "age_bucket_encoded": code_of("age_bucket_encoded", AGE_CODES),
        "behavioral_cohort": behavioral_cohort(decay),
        "risk_tier": risk_tier(decay),
        "split": "CASE WHEN is_churn IS NOT NULL THEN 'train' ELSE 'score' END",
    }
    return master.selectExpr(
        *[f"{shaped[c]} AS {c}" if c in shaped else c for c in CHURN_MART_COLUMNS]
    )


# Mart columns carried into the treatment results, in order.
TREATMENT_FEATURES = (
    "usage_decay_30d", "usage_decay_60d", "usage_decay_90d", "sessions_last_30d",
    "sessions_last_60d", "sessions_last_90d", "avg_session_duration_30d",
    "login_days_last_30d", "login_gap_days_avg", "login_streak_max",
    "days_since_last_login", "ticket_count_30d", "ticket_count_90d", "ticket_velocity",
    "pct_negative_sentiment", "unresolved_ticket_count", "has_cancellation_inquiry",
    "auto_renew_flag", "plan_downgrade_flag", "payment_failure_count_90d",
    "days_since_last_txn", "avg_discount_rate", "unique_features_used_30d",
    "feature_diversity_score", "days_since_last_feature_use", "change_point_detected",
    "days_since_change_point", "usage_slope_post_change", "gender_male_flag",
    "city_encoded", "age_bucket_encoded", "tenure_days", "behavioral_cohort", "risk_tier",
)


def latest_per_treatment(interventions: DataFrame) -> DataFrame:
    newest = "max(struct(intervention_date, email_opened, email_clicked))"
    return (
        interventions.groupBy("msno", "intervention_type")
        .agg(*columns({"last": newest}))
        .select("msno", "intervention_type", "last.email_opened", "last.email_clicked")
    )


def intervention_mart(mart: DataFrame, interventions: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Uplift training rows: every outcome of a labelled user with treatment and features.

    Repeated sends of one treatment count once (the latest), so a user with many of them
    does not multiply rows.
    """
    labelled = mart.filter("is_churn IS NOT NULL")
    joined = (
        outcomes.join(latest_per_treatment(interventions), ["msno", "intervention_type"])
        .join(labelled.select("msno", *TREATMENT_FEATURES), "msno")
    )
    return joined.selectExpr(
        "msno",
        "intervention_type",
        f"{code_of('intervention_type', TREATMENT_CODES)} AS intervention_type_encoded",
        "email_opened",
        "email_clicked",
        "observed_churn",
        "was_saved",
        "renewed",
        *TREATMENT_FEATURES,
    )
