"""Churn classifier, uplift models, their evaluation and their storage, on Spark ML."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import partial
from typing import TypeVar

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from staywise.config import (
    CHURN_FEATURES,
    INTERVENTION_TYPES,
    TREATMENT_CODES,
    UPLIFT_FEATURES,
    EngineConfig,
)
from staywise.functions.columns import columns
from staywise.operators.boosting import fit_all
from staywise.operators.evaluation import class_weight
from staywise.operators.scoring import churn_flag, feature_columns
from staywise.operators.treeshap import leaves_of, tree_attributions
from staywise.sources.readers import path_exists
from staywise.sources.writers import commit, committed, settle


@dataclass(frozen=True)
class BoostingParams:
    """The published settings of the churn booster."""

    trees: int = 300
    depth: int = 6
    rate: float = 0.05
    subsample: float = 0.8
    feature_subset: str = "0.8"
    min_rows: int = 10
    seed: int = 42


@dataclass(frozen=True)
class TrainedModel:
    """A fitted pipeline with the features it was trained on."""

    pipeline: PipelineModel
    features: tuple[str, ...] = field(default=CHURN_FEATURES)

    @property
    def booster(self) -> GBTClassificationModel:
        return self.pipeline.stages[-1]


def training_rows(
    frame: DataFrame, label: str, features: tuple[str, ...] = CHURN_FEATURES
) -> DataFrame:
    """Label, features as doubles, and the class-imbalance weight of each row.

    The weight is one aggregate row, read by the plan as a scalar subquery.
    """
    rows = frame.filter(f"{label} IS NOT NULL").selectExpr(
        "msno", f"CAST(CAST({label} AS INT) AS DOUBLE) AS label", *feature_columns(frame, features)
    )
    positive = class_weight(rows, "label").scalar()
    return rows.withColumn("weight", F.when(F.col("label") == 1.0, positive).otherwise(F.lit(1.0)))


T = TypeVar("T")


def at_once(*fits: Callable[[], T]) -> list[T]:
    """Results of calls that run side by side; their jobs fill the gaps of each other."""
    spark = SparkSession.active()
    with ThreadPoolExecutor(max(len(fits), 1)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(fit)) for fit in fits]]


def _pipeline(features: tuple[str, ...], params: BoostingParams) -> Pipeline:
    booster = GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxIter=params.trees,
        maxDepth=params.depth,
        stepSize=params.rate,
        subsamplingRate=params.subsample,
        featureSubsetStrategy=params.feature_subset,
        minInstancesPerNode=params.min_rows,
        seed=params.seed,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), booster])


#: Training rows and the features to train on.
Fit = tuple[DataFrame, tuple[str, ...]]


def trained(fits: list[Fit], params: BoostingParams) -> list[TrainedModel]:
    """A model for each of the fits; a tree level of all of them is one job."""
    pipelines = [_pipeline(names, params) for _, names in fits]
    return [TrainedModel(f, names) for f, (_, names) in zip(fit_all(fits, pipelines, params), fits)]


def churn_fit(mart: DataFrame, features: tuple[str, ...] = CHURN_FEATURES) -> Fit:
    return training_rows(mart, "is_churn", features), features


def train_churn(
    mart: DataFrame,
    params: BoostingParams = BoostingParams(),
    features: tuple[str, ...] = CHURN_FEATURES,
) -> TrainedModel:
    return trained([churn_fit(mart, features)], params)[0]


def cross_validate(
    mart: DataFrame,
    params: BoostingParams = BoostingParams(),
    features: tuple[str, ...] = CHURN_FEATURES,
    folds: int = 5,
    depths: tuple[int, ...] | None = None,
) -> DataFrame:
    """Mean and spread of the area under the precision-recall curve over the folds.

    A user's fold is a hash of the key, whatever the table's partitions are. All folds are
    fitted together over the same written rows.
    """
    fold = f"CAST(pmod(xxhash64(msno, {params.seed}), {folds}) AS INT)"
    rows = settle(training_rows(mart, "is_churn", features).withColumn("fold", F.expr(fold)))
    measure = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderPR")

    def area(model: TrainedModel, k: int) -> float:
        return measure.evaluate(model.pipeline.transform(rows.filter(f"fold = {k}")))

    grid = depths or (params.depth,)
    fits = [(rows.filter(f"fold <> {k}"), features) for k in range(folds)]
    areas = []
    for depth in grid:
        fitted = trained(fits, replace(params, depth=depth))
        areas += at_once(*[partial(area, model, k) for k, model in enumerate(fitted)])
    found = np.array(areas).reshape(len(grid), folds)
    rows_out = [(d, folds, float(a.mean()), float(a.std())) for d, a in zip(grid, found)]
    schema = "max_depth int, folds int, mean_auc_pr double, std_auc_pr double"
    return mart.sparkSession.createDataFrame(rows_out, schema)


def probabilities(frame: DataFrame, model: TrainedModel, *keep: str) -> DataFrame:
    """``keep`` columns and ``prob``; no shuffle."""
    named = [f"__{k}" for k in keep]
    rows = frame.selectExpr(
        *[f"{k} AS {n}" for k, n in zip(keep, named)], *feature_columns(frame, model.features)
    )
    scored = model.pipeline.transform(rows)
    return scored.select(
        *[F.col(n).alias(k) for k, n in zip(keep, named)],
        vector_to_array("probability")[1].alias("prob"),
    )


def score_users(mart: DataFrame, model: TrainedModel, cfg: EngineConfig) -> DataFrame:
    """Churn probability and high-risk flag of every user."""
    return probabilities(mart, model, "msno").selectExpr(
        "msno", "prob AS churn_prob", f"{churn_flag('prob', cfg)} AS churn_flag"
    )


TREATMENT = "intervention_type_encoded"


def uplift_fits(treatments: DataFrame, features: tuple[str, ...] = UPLIFT_FEATURES) -> list[Fit]:
    """Treated and untreated users with the features of their models."""

    def rows(condition: str, names: tuple[str, ...]) -> Fit:
        chosen = treatments.filter(f"intervention_type {condition} 'no_treatment'")
        return training_rows(chosen, "observed_churn", names), names

    return [rows("<>", features), rows("=", tuple(f for f in features if f != TREATMENT))]


def train_uplift(
    treatments: DataFrame,
    params: BoostingParams = BoostingParams(),
    features: tuple[str, ...] = UPLIFT_FEATURES,
) -> tuple[TrainedModel, TrainedModel]:
    """One model on treated, one on untreated users (T-learner).

    The treated model also sees which treatment it was; among the untreated that is constant.
    """
    treated, control = trained(uplift_fits(treatments, features), params)
    return treated, control


def uplift_by_treatment(
    frame: DataFrame, treated: TrainedModel, control: TrainedModel, *keep: str
) -> DataFrame:
    """``keep`` columns and ``uplift_<treatment>`` for each treatment a plan may contain.

    Churn probability untreated minus treated: one run of the control model, one of the
    treated model per treatment, and no shuffle.
    """
    wanted = dict.fromkeys((*keep, *treated.features))
    kept = [c for c in wanted if c in frame.columns and c != TREATMENT]
    base = probabilities(frame, control, *kept).withColumnRenamed("prob", "p_control")
    if TREATMENT not in treated.features:
        both = probabilities(base, treated, *keep, "p_control")
        uplift = "p_control - prob"
        return both.selectExpr(*keep, *[f"{uplift} AS uplift_{t}" for t in INTERVENTION_TYPES])
    out = base
    for name in INTERVENTION_TYPES:
        asked = out.selectExpr("*", f"{TREATMENT_CODES[name]} AS {TREATMENT}")
        carried = [c for c in out.columns if c != TREATMENT]
        out = probabilities(asked, treated, *carried).withColumnRenamed("prob", f"p_{name}")
    return out.selectExpr(*keep, *[f"p_control - p_{t} AS uplift_{t}" for t in INTERVENTION_TYPES])


def uplift_scores(
    frame: DataFrame, treated: TrainedModel, control: TrainedModel, *keep: str
) -> DataFrame:
    """``keep`` columns and ``uplift_score``: that of the treatment that helps most.

    Transforms of one scan, no join.
    """
    each = uplift_by_treatment(frame, treated, control, *keep)
    best = ", ".join(f"uplift_{t}" for t in INTERVENTION_TYPES)
    return each.selectExpr(*keep, f"greatest({best}) AS uplift_score")


def score_and_explain(
    mart: DataFrame,
    churn: TrainedModel,
    cfg: EngineConfig,
    uplift: tuple[TrainedModel, TrainedModel] | None = None,
) -> DataFrame:
    """Probability and flag of everyone; attributions and uplift of the high-risk users.

    Everyone is scored once; the scores are written with the model inputs, and flagged and
    other rows are read back as two branches that a union puts together. So each model runs
    once per row, only flagged rows reach Python and nothing is shuffled. Uplift is NULL when
    there are no uplift models.
    """
    matrix = mart.selectExpr("msno", *feature_columns(mart, _all_features(churn, uplift)))
    inputs = [c for c in matrix.columns if c != "msno"]
    scored = settle(
        probabilities(matrix, churn, "msno", *inputs).selectExpr(
            "msno", "prob AS churn_prob", f"{churn_flag('prob', cfg)} AS churn_flag", *inputs
        )
    )
    head = ("msno", "churn_prob", "churn_flag", "uplift_score")
    flagged = scored.filter("churn_flag = 1")
    if uplift is None:
        flagged = flagged.selectExpr("*", "CAST(NULL AS DOUBLE) AS uplift_score")
    else:
        flagged = uplift_scores(flagged, *uplift, *head[:3], *inputs)
    explained = tree_attributions(flagged, leaves_of(churn.booster), churn.features, *head)
    others = scored.filter("churn_flag = 0").selectExpr(
        *head[:3],
        *[f"CAST(NULL AS DOUBLE) AS {c}" for c in explained.columns if c not in head[:3]],
    )
    return explained.unionByName(others)


def _all_features(
    churn: TrainedModel, uplift: tuple[TrainedModel, TrainedModel] | None
) -> tuple[str, ...]:
    models = (churn, *(uplift or ()))
    return tuple(dict.fromkeys(f for m in models for f in m.features if f != TREATMENT))


def uplift_summary(scored: DataFrame, cfg: EngineConfig) -> DataFrame:
    metrics = {
        "mean_uplift": "avg(uplift_score)",
        "persuadable_users": f"count_if(uplift_score > {cfg.uplift_min}D)",
        "scored_users": "count(uplift_score)",
    }
    return scored.agg(*columns(metrics))


def feature_importance(spark: SparkSession, model: TrainedModel, n: int = 20) -> DataFrame:
    """Most important features; the vector has one entry per model column."""
    values = model.booster.featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(model.features, values)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(n)


# ---- storage ---------------------------------------------------------------------------


def save_models(folder: str, models: dict[str, TrainedModel], facts: dict[str, dict] | None = None) -> None:
    """Store models that belong together as one version, which replaces the set before.

    Each is a pipeline and one JSON row with the feature list and further facts. Readers see the
    former set until all are written.
    """
    spark = SparkSession.active()
    schema = "name string, features array<string>, facts map<string,string>"

    def write(path: str) -> None:
        for name, model in models.items():
            model.pipeline.write().save(f"{path}/{name}/model")
            known = {k: str(v) for k, v in (facts or {}).get(name, {}).items()}
            row = [(name, list(model.features), known)]
            spark.createDataFrame(row, schema).coalesce(1).write.json(f"{path}/{name}/about")

    commit(spark, folder, write)


def save_model(model: TrainedModel, folder: str, name: str, **facts) -> None:
    """Store one model as the whole set of ``folder``."""
    save_models(folder, {name: model}, {name: facts})


def load_model(folder: str, name: str) -> TrainedModel | None:
    """The stored model, or None when the current set has none of that name."""
    spark = SparkSession.active()
    done = committed(spark, folder)
    if done is None or not path_exists(spark, f"{done[0]}/{name}/model"):
        return None
    about = _about(f"{done[0]}/{name}")
    return TrainedModel(PipelineModel.load(f"{done[0]}/{name}/model"), tuple(about["features"]))


def load_metadata(folder: str, name: str) -> dict:
    return _about(f"{committed(SparkSession.active(), folder)[0]}/{name}")


def _about(path: str) -> dict:
    schema = "name string, features array<string>, facts map<string,string>"
    return SparkSession.active().read.schema(schema).json(f"{path}/about").first().asDict()
