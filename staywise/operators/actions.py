"""Action plan, its summaries, user lookups and campaign measurement."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staywise.config import INTERVENTION_TYPES, EngineConfig
from staywise.functions.columns import columns, round_to
from staywise.operators.explain import top_factors
from staywise.sources.readers import usable_key


def final_action(cfg: EngineConfig) -> str:
    """The recommendation, if the user is persuadable and the action is an offered one."""
    offered = ", ".join(f"'{a}'" for a in INTERVENTION_TYPES)
    return f"""CASE WHEN uplift_score >= {cfg.uplift_min}D AND recommended_action IN ({offered})
                    THEN recommended_action ELSE 'no_action' END"""


def select_interventions(scored: DataFrame, narratives: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Action plan of the high-risk users."""
    told = narratives.select("msno", "recommended_action", "explanation", "action_justification")
    return (
        scored.filter("churn_flag = 1")
        .select("msno", "churn_prob", "uplift_score")
        .join(told, "msno", "left")
        .selectExpr(
            "msno",
            "churn_prob",
            "uplift_score",
            f"{final_action(cfg)} AS final_action",
            "explanation",
            "action_justification",
        )
    )


def plan_kpis(plan: DataFrame) -> DataFrame:
    acted = "count_if(final_action <> 'no_action')"
    metrics = {
        "high_risk_users": "count(*)",
        "actionable_users": acted,
        "intervention_rate": round_to(f"try_divide({acted} * 100D, count(*))", 1),
    }
    return plan.agg(*columns(metrics))


def top_plan(plan: DataFrame, n: int = 200) -> DataFrame:
    """Riskiest users of the plan, ties by key (a top-n per task, then one merge)."""
    return plan.orderBy(F.desc("churn_prob"), "msno").limit(n)


def segment_summary(plan: DataFrame, mart: DataFrame, segment: str) -> DataFrame:
    """Users, mean risk and intervention share per segment; users without one are left out."""
    acted = "avg(CASE WHEN final_action <> 'no_action' THEN 1D ELSE 0D END) * 100D"
    metrics = {
        "high_risk_users": "count(DISTINCT msno)",
        "avg_churn_prob": "avg(churn_prob)",
        "intervention_rate": round_to(acted, 1),
    }
    return (
        plan.join(mart.select("msno", segment), "msno", "left")
        .filter(f"{segment} IS NOT NULL")
        .groupBy(segment)
        .agg(*columns(metrics))
        .orderBy(F.desc("avg_churn_prob"))
    )


def risk_lookup(
    keys: DataFrame, scored: DataFrame, narratives: DataFrame, change_points: DataFrame, n: int = 5
) -> DataFrame:
    """Risk record of each requested user; unknown keys give no row."""
    wanted = keys.filter(usable_key()).select("msno").distinct()
    shifts = change_points.select("msno", "change_point_detected", "change_point_date")
    record = scored.join(wanted, "msno", "left_semi").selectExpr(
        "msno",
        "churn_prob AS churn_probability",
        "churn_flag = 1 AS churn_flag",
        f"{top_factors(scored, n)} AS top_risk_factors",
        "uplift_score",
    )
    joined = record.join(narratives, "msno", "left").join(shifts, "msno", "left")
    return joined.selectExpr(
        *record.columns,
        *[c for c in narratives.columns if c != "msno"],
        "coalesce(change_point_detected, false) AS change_point_detected",
        "CAST(change_point_date AS STRING) AS change_point_date",
    )


def save_rate(outcomes: DataFrame) -> DataFrame:
    """Share of saved churners among treated and untreated users, and the difference."""

    def rate(condition: str) -> str:
        return f"avg(CASE WHEN intervention_type {condition} 'no_treatment' THEN CAST(was_saved AS INT) END)"

    treated, control = rate("<>"), rate("=")
    metrics = {
        "treated_save_rate": treated,
        "control_save_rate": control,
        "save_rate_lift": f"{treated} - {control}",
    }
    return outcomes.agg(*columns(metrics))
