"""End-to-end jobs: ingest, features, scoring, the full run and retraining.

Stages that several later steps read are written to the output folder and read back;
between them everything is one lazy plan.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from staywise.config import EngineConfig
from staywise.operators import actions, changepoint, drift, evaluation, explain, models, narration
from staywise.plans.tables import Tables
from staywise.sources import readers
from staywise.sources.schemas import RAW_TABLES
from staywise.sources.writers import committed, export, read_stage, register_views, replace_stage

log = logging.getLogger(__name__)

# Turns prompts (msno, prompt) into replies (msno, reply).
Narrator = Callable[[DataFrame], DataFrame]

REQUIRED = ("raw_members", "raw_train", "raw_transactions", "raw_user_logs")


@dataclass(frozen=True)
class Job:
    """Where a run reads and writes, and how."""

    core_dir: str
    saas_dir: str
    out_dir: str
    cfg: EngineConfig = EngineConfig()
    params: models.BoostingParams = models.BoostingParams()
    # Most users a narrator is asked about, None for all flagged ones.
    narrated: int | None = None
    # Where replies are kept between runs, None to ask for all of them each time; how many
    # prompts go to the narrator at a time, and how often a batch is tried.
    reply_store: str | None = None
    narration_batch: int = 10_000
    narration_attempts: int = 3
    # Folds of the cross-validation in training, 0 for none.
    folds: int = 5
    # Format of the exports for other tools, next to the Parquet ones: "csv" or None.
    hand_off: str | None = None
    # Name of the run: started again under it, a run goes on behind the stages it has committed.
    run: str = ""

    def path(self, name: str) -> str:
        return f"{self.out_dir.rstrip('/')}/{name}"

    @property
    def model_dir(self) -> str:
        return self.path("models")


def ingest(spark: SparkSession, job: Job) -> dict[str, DataFrame]:
    """Raw tables as views; product tables without a file are empty."""
    raw = readers.load_raw_tables(spark, job.core_dir, job.saas_dir)
    missing = [t for t in REQUIRED if t not in raw]
    if missing:
        raise FileNotFoundError(f"{job.core_dir}: no file for {', '.join(missing)}")
    for table in RAW_TABLES:
        if table not in raw:
            raw[table] = readers.empty_table(spark, table)
    register_views(raw)
    return raw


def hand_off(spark: SparkSession, job: Job, *names: str) -> None:
    """Write exports once more in the format other tools ask for."""
    for name in names if job.hand_off else ():
        export(readers.read_export(spark, job.path(name)), job.path(f"{name}_{job.hand_off}"), job.hand_off)


def build_tables(spark: SparkSession, job: Job, raw: dict[str, DataFrame]) -> Tables:
    def stage(name: str, frame: DataFrame) -> DataFrame:
        return replace_stage(frame, job.path(f"stages/{name}"), run=job.run)

    return Tables(raw, job.cfg, stage=stage)


def run_features(spark: SparkSession, job: Job) -> Tables:
    """Ingest, staging, change points, features, marts and their exports.

    Change points are detected before the wide table, so they are among its features.
    """
    tables = build_tables(spark, job, ingest(spark, job))
    export(tables.change_points, job.path("change_points"), key="msno")
    export(tables.mart.filter("split = 'train'"), job.path("features_train"))
    trained_on = readers.read_export(spark, job.path("features_train"))
    replace_stage(drift.reference_profile(trained_on), job.path("reference_profile"), run=job.run)
    export(tables.mart, job.path("features_score"))
    export(tables.intervention_mart, job.path("intervention_results"))
    hand_off(spark, job, "change_points", "features_train", "features_score")
    shares = changepoint.detected_share(tables.change_points).first()
    log.info("change points: %s of %s users", shares["detected_users"], shares["users"])
    return tables


def measure(mart: DataFrame, job: Job) -> dict[str, float]:
    """Hold-out AUC and average precision of a model fitted on the rest, and the folds' AUC-PR."""
    labelled = mart.filter("is_churn IS NOT NULL")
    marks = evaluation.stratified_split(labelled, "xxhash64(msno, 42)")
    tagged = replace_stage(
        labelled.join(marks.select("msno", "is_validation"), "msno"), job.path("stages/split")
    )
    model = models.train_churn(tagged.filter("NOT is_validation"), job.params)
    held_out = models.probabilities(tagged.filter("is_validation"), model, "msno", "is_churn")
    scores = held_out.withColumnRenamed("prob", "churn_prob")
    found = {
        "holdout_auc_roc": evaluation.auc_roc(scores).first()[0],
        "holdout_average_precision": evaluation.average_precision(scores).first()[0],
    }
    if job.folds:
        folds = models.cross_validate(mart, job.params, folds=job.folds).first()
        found |= {"cv_mean_auc_pr": folds["mean_auc_pr"], "cv_std_auc_pr": folds["std_auc_pr"]}
    log.info("model quality: %s", found)
    return found


def train(spark: SparkSession, job: Job) -> None:
    """Fit, measure and store the churn classifier; fit and store both uplift models."""
    mart = readers.read_export(spark, job.path("features_train"))
    quality = measure(mart, job)
    churn = models.train_churn(mart, job.params)
    treatments = readers.read_export(spark, job.path("intervention_results"))
    treated, control = models.train_uplift(treatments, job.params)
    fitted = {"churn_classifier": churn, "uplift_treatment": treated, "uplift_control": control}
    facts = {name: {"trees": job.params.trees} for name in fitted}
    facts["churn_classifier"] |= quality
    models.save_models(job.model_dir, fitted, facts)


def score(spark: SparkSession, job: Job) -> DataFrame:
    """Score every exported user; attributions and uplift for the high-risk ones."""
    churn = models.load_model(job.model_dir, "churn_classifier")
    if churn is None:
        raise FileNotFoundError(f"{job.model_dir}: train the churn classifier first")
    treated = models.load_model(job.model_dir, "uplift_treatment")
    control = models.load_model(job.model_dir, "uplift_control")
    pair = (treated, control) if treated and control else None
    if pair is None:
        log.warning("no uplift models, uplift stays NULL")
    features, seen = readers.load_features(spark, job.path("features_score"))
    export(models.score_and_explain(features, churn, job.cfg, pair), job.path("scored_users"), key="msno")
    if seen.get["rows_dropped"]:
        log.warning("left out rows without a key: %s", seen.get)
    return readers.read_export(spark, job.path("scored_users"))


def narrate(spark: SparkSession, job: Job, scored: DataFrame, narrator: Narrator | None) -> DataFrame:
    """Narratives of all flagged users, from replies to prompts or from the template.

    With ``job.narrated`` set, the narrator (a service with a rate limit) is asked about so
    many of the riskiest users; everyone else gets the template.
    """
    flagged = scored.filter("churn_flag = 1")
    shifts = readers.load_change_points(spark, job.path("change_points"))
    if narrator is None:
        return explain.template_narrative(flagged, shifts)
    if job.reply_store:
        service = narrator

        def narrator(asked: DataFrame) -> DataFrame:
            return narration.replies_to(
                asked, service, job.reply_store, job.narration_batch, job.narration_attempts
            )

    context = readers.read_export(spark, job.path("features_score"))
    if job.narrated is None:
        return explain.parse_replies(narrator(explain.prompts(flagged, shifts, context, job.cfg)))
    asked = explain.narration_candidates(flagged, replace(job.cfg, narration_list=job.narrated))
    told = explain.parse_replies(narrator(explain.prompts(asked, shifts, context, job.cfg)))
    others = flagged.join(asked.select("msno"), "msno", "left_anti")
    return told.unionByName(explain.template_narrative(others, shifts))


def plan_actions(
    spark: SparkSession, job: Job, scored: DataFrame, narrator: Narrator | None = None
) -> DataFrame:
    narratives = narrate(spark, job, scored, narrator)
    export(actions.select_interventions(scored, narratives, job.cfg), job.path("action_plan"))
    hand_off(spark, job, "action_plan")
    plan = readers.read_export(spark, job.path("action_plan"))
    kpis = actions.plan_kpis(plan).first()
    log.info("%s high-risk users, %s actionable", kpis["high_risk_users"], kpis["actionable_users"])
    return plan


def run_full(spark: SparkSession, job: Job, narrator: Narrator | None = None) -> DataFrame:
    """Raw files to action plan."""
    run_features(spark, job)
    train(spark, job)
    return plan_actions(spark, job, score(spark, job), narrator)


def drift_report(
    spark: SparkSession, job: Job, reference_path: str | None = None, current_path: str | None = None
) -> DataFrame:
    """Drift of one export against another, by default of the scored against the training users.

    Of the training users the profile stored with their export is read, if there is one.
    """
    if reference_path is None and committed(spark, job.path("reference_profile")):
        profile = read_stage(spark, job.path("reference_profile"))
        current = readers.read_export(spark, current_path or job.path("features_score"))
        return drift.drift_summary(drift.psi_against(profile, current, job.cfg), job.cfg)
    reference = readers.read_export(spark, reference_path or job.path("features_train"))
    current = readers.read_export(spark, current_path or job.path("features_score"))
    return drift.drift_summary(drift.psi_by_feature(reference, current, job.cfg), job.cfg)


def distribution_report(
    spark: SparkSession, job: Job, reference_path: str | None = None, current_path: str | None = None
) -> DataFrame:
    """Largest gap between the distributions of each feature in the same two exports."""
    reference = readers.read_export(spark, reference_path or job.path("features_train"))
    current = readers.read_export(spark, current_path or job.path("features_score"))
    return drift.ks_by_feature(reference, current)


def segment_tables(spark: SparkSession, job: Job) -> dict[str, DataFrame]:
    """Plan summaries by tier and by cohort from a run's exports."""
    plan = readers.read_export(spark, job.path("action_plan"))
    mart = readers.read_export(spark, job.path("features_score"))
    return {s: actions.segment_summary(plan, mart, s) for s in ("risk_tier", "behavioral_cohort")}


def lookup(spark: SparkSession, job: Job, users: DataFrame) -> DataFrame:
    """Risk records for a table of keys (``msno``) from a run's exports."""
    scored = readers.rows_of_keys(readers.read_export(spark, job.path("scored_users")), users)
    shifts = readers.rows_of_keys(
        readers.load_change_points(spark, job.path("change_points")), users
    )
    return actions.risk_lookup(users, scored, explain.template_narrative(scored, shifts), shifts)


def run_retraining(spark: SparkSession, job: Job, force: bool = False) -> bool:
    """Rebuild features and models when drift asks for it; tells whether it did."""
    if not drift.should_retrain(lambda: drift_report(spark, job), force):
        return False
    run_features(spark, job)
    train(spark, job)
    return True
