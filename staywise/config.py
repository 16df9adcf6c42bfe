"""Immutable settings shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Model feature columns, in their published order.
CHURN_FEATURES = (
    "usage_decay_30d",
    "usage_decay_60d",
    "usage_decay_90d",
    "sessions_last_30d",
    "sessions_last_60d",
    "sessions_last_90d",
    "avg_session_duration_30d",
    "login_days_last_30d",
    "login_gap_days_avg",
    "login_streak_max",
    "ticket_count_30d",
    "ticket_count_90d",
    "pct_negative_sentiment",
    "unresolved_ticket_count",
    "has_cancellation_inquiry",
    "plan_downgrade_flag",
    "payment_failure_count_90d",
    "auto_renew_flag",
    "days_since_last_txn",
    "unique_features_used_30d",
    "feature_diversity_score",
    "days_since_last_feature_use",
    "change_point_detected",
    "days_since_change_point",
    "usage_slope_post_change",
    "tenure_days",
    "city_encoded",
    "age_bucket_encoded",
)

UPLIFT_FEATURES = CHURN_FEATURES + ("intervention_type_encoded",)

# The retention actions a plan may contain.
INTERVENTION_TYPES = (
    "discount_offer",
    "feature_highlight_email",
    "personal_outreach",
    "re_onboarding_flow",
)

# Treatment codes for model input; any other type is 0.
TREATMENT_CODES = {
    "no_treatment": 0,
    "discount_offer": 1,
    "feature_highlight_email": 2,
    "personal_outreach": 3,
    "re_onboarding_flow": 4,
}

# Human labels of model features.
FEATURE_LABELS = {
    "usage_decay_30d": "30-day usage decay",
    "usage_decay_60d": "60-day usage decay",
    "ticket_count_30d": "support tickets (last 30 days)",
    "pct_negative_sentiment": "% negative support sentiment",
    "has_cancellation_inquiry": "cancellation inquiry ticket",
    "plan_downgrade_flag": "plan downgrade",
    "login_days_last_30d": "login days (last 30 days)",
    "days_since_last_feature_use": "days since last feature use",
    "unique_features_used_30d": "unique features used (30 days)",
    "payment_failure_count_90d": "payment failures (90 days)",
    "change_point_detected": "behavioral change point detected",
    "days_since_change_point": "days since behavior changed",
    "pct_usage_change": "% change in usage after shift",
}

# Columns that never enter a drift comparison.
DRIFT_EXCLUDED = (
    "msno",
    "is_churn",
    "split",
    "behavioral_cohort",
    "risk_tier",
    "change_point_date",
    "last_intervention_type",
)


@dataclass(frozen=True)
class EngineConfig:
    """Parameters of the feature, scoring, planning and monitoring operators."""

    ref_date: date = date(2017, 3, 31)
    # (length, recent half ends at) of the three look-back windows, in days.
    windows: tuple[tuple[int, int], ...] = ((30, 15), (60, 30), (90, 45))
    product_feature_count: int = 10

    churn_threshold: float = 0.65
    uplift_min: float = 0.05

    # Share of drifted columns that calls for retraining, and the per-column limit.
    drift_share: float = 0.2
    psi_threshold: float = 0.2
    psi_bins: int = 10
    psi_floor: float = 1e-6

    cp_min_days: int = 14
    cp_penalty: float = 10.0
    cp_min_size: int = 2
    cp_grid: int = 5

    # Length of the list of the riskiest users (narration_candidates).
    narration_list: int = 200
    top_factors: int = 5
