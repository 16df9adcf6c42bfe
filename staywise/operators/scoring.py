"""Model matrix, linear scoring and its additive attributions as column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, types as T

from staywise.config import CHURN_FEATURES, EngineConfig
from staywise.functions.columns import columns


def feature_columns(frame: DataFrame, features: tuple[str, ...] = CHURN_FEATURES) -> list[str]:
    """The model features as doubles; NULL and columns the frame lacks become 0."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}

    def number(name: str) -> str:
        if name not in kinds:
            return f"0D AS {name}"
        inner = f"CAST({name} AS INT)" if isinstance(kinds[name], T.BooleanType) else name
        return f"coalesce(CAST({inner} AS DOUBLE), 0D) AS {name}"

    return [number(name) for name in features]


def churn_flag(probability: str, cfg: EngineConfig) -> str:
    return f"CASE WHEN {probability} >= {cfg.churn_threshold}D THEN 1 ELSE 0 END"


def linear_score(coefficients: dict[str, float], intercept: float) -> str:
    """Logistic probability of a linear model over feature columns."""
    terms = "".join(f" + {name} * ({weight}D)" for name, weight in coefficients.items())
    return f"(1D / (1D + exp(-({intercept}D{terms}))))"


def linear_attributions(frame: DataFrame, coefficients: dict[str, float], only_if: str) -> DataFrame:
    """``shap_<feature>`` = weight * (value - population mean), NULL where not wanted.

    The means are one row, read by the plan as a scalar subquery.
    """
    means = frame.agg(*columns({"m": f"named_struct({_pairs(coefficients)})"})).scalar()
    parts = {
        f"shap_{c}": f"CASE WHEN {only_if} THEN ({c} - __means.{c}) * ({w}D) END"
        for c, w in coefficients.items()
    }
    return frame.withColumn("__means", means).select("*", *columns(parts)).drop("__means")


def _pairs(names) -> str:
    return ", ".join(f"'{c}', avg({c})" for c in names)


def high_risk_summary(scored: DataFrame) -> DataFrame:
    return scored.agg(
        *columns(
            {
                "scored_users": "count(*)",
                "high_risk_users": "count_if(churn_flag = 1)",
                "high_risk_share": "try_divide(count_if(churn_flag = 1), count(*))",
            }
        )
    )
