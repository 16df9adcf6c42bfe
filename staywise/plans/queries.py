"""Registered queries over the test tables and their oracle SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from staywise.config import INTERVENTION_TYPES
from staywise.functions.columns import round_to
from staywise.operators import (
    actions,
    changepoint,
    drift,
    evaluation,
    explain,
    features,
    models,
    narration,
    profile,
    scoring,
    sessions,
    treeshap,
)
from staywise.plans import oracle, pipelines
from staywise.plans.tables import Tables
from staywise.sources import readers, testdata
from staywise.sources.schemas import RAW_TABLES
from staywise.sources.writers import export, settle, shared_dir

CFG = testdata.TEST_CONFIG

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def halfway(series: DataFrame) -> DataFrame:
    """A change in the middle of every history of 16 days or more.

    Stands in for detection where everything after it must be comparable with SQL.
    """
    rule = "CASE WHEN size(secs) >= 16 THEN size(secs) DIV 2 END"
    return series.selectExpr("*", f"CAST({rule} AS INT) AS cp_idx")


def keep_mart(name: str, frame: DataFrame) -> DataFrame:
    """Write the mart, as a pipeline run does; what follows reads it more than once."""
    return settle(frame) if name == "mart_churn_features" else frame


def keep_marts(name: str, frame: DataFrame) -> DataFrame:
    """Write both marts: training passes over them many times."""
    return settle(frame) if name.startswith("mart_") else frame


def tables(spark: SparkSession, sf_dir: str, stage=None) -> Tables:
    raw = testdata.RawTables(spark, sf_dir)
    return Tables(raw, CFG, stage=stage, locate=halfway)


def _rounded(frame: DataFrame, digits: int, *names: str) -> DataFrame:
    """Results of order-dependent float sums, cut to the digits both engines agree on."""
    return frame.withColumns({c: F.expr(round_to(c, digits)) for c in names})


def register(name: str, sql: str | None = None, stage=None):
    """Add a query; ``sql`` is its oracle, by default the block of the same name."""

    def add(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: build(tables(spark, sf_dir, stage))
        if sql is not None:
            ORACLE[name] = oracle.compose(sql)
        elif name in oracle.BLOCKS:
            ORACLE[name] = oracle.table(name)
        return build

    return add


# ---- staging ---------------------------------------------------------------------------

register("stg_members")(lambda t: t.members)
register("stg_user_logs")(lambda t: t.user_logs)
register("stg_transactions")(lambda t: t.transactions)
register("stg_feature_events")(lambda t: t.feature_events)
register("stg_support_tickets")(lambda t: t.support_tickets)
register("stg_interventions")(lambda t: t.interventions)
register("stg_outcomes")(lambda t: t.outcomes)


@register(
    "sampled_user_logs",
    "SELECT * FROM raw_user_logs WHERE msno IN "
    "(SELECT msno FROM raw_members WHERE CAST(msno AS BIGINT) * 7919 % 1009 % 10 < 3)",
)
def sampled_user_logs(t: Tables) -> DataFrame:
    """A 30 % user sample and the log rows of exactly those users."""
    draw = F.pmod(F.col("msno").cast("long") * 7919, F.lit(1009))
    users = readers.sample_user_share(t.raw["raw_members"], draw, buckets=10, keep=3)
    return readers.rows_of_users(t.raw["raw_user_logs"], users)


# ---- sessions and features -------------------------------------------------------------

register("daily_activity")(lambda t: sessions.daily_activity(t.rollup))
register("sessions")(lambda t: sessions.sessions(t.rollup))
register("session_gaps")(lambda t: sessions.session_gaps(sessions.sessions(t.rollup)))
register("login_frequency")(lambda t: sessions.login_frequency(t.rollup, CFG))
register("usage_decay")(lambda t: sessions.usage_decay(t.rollup, CFG))
register("support_signals")(lambda t: features.support_signals(t.support_tickets, CFG))
register("latest_transaction")(lambda t: features.latest_transaction(t.payments))
register("transaction_signals")(lambda t: features.transaction_signals(t.transactions, CFG))
register("feature_adoption")(lambda t: features.feature_adoption(t.feature_events, CFG))
register("intervention_engagement")(lambda t: features.intervention_engagement(t.interventions))
register("last_transaction_date")(
    lambda t: features.last_transaction_date(t.raw["raw_transactions"])
)


@register("activity_stats")
def activity_stats(t: Tables) -> DataFrame:
    return _rounded(features.activity_stats(t.raw["raw_user_logs"]), 3, "total_seconds_std")


register("feature_master")(lambda t: t.feature_master)
register("churn_mart")(lambda t: t.mart)
register("intervention_mart")(lambda t: t.intervention_mart)
register("change_point_stats")(
    lambda t: changepoint.change_point_stats(halfway(changepoint.user_series(t.rollup)))
)
register("change_points")(lambda t: changepoint.detect_change_points(t.rollup, CFG))
register("change_point_share")(
    lambda t: changepoint.detected_share(changepoint.detect_change_points(t.rollup, CFG))
)


# ---- scoring with fixed coefficients ---------------------------------------------------

WEIGHTS = {
    "usage_decay_30d": 1.2,
    "sessions_last_30d": -0.08,
    "ticket_count_30d": 0.35,
    "login_days_last_30d": -0.05,
    "pct_negative_sentiment": 0.7,
    "has_cancellation_inquiry": 0.9,
    "payment_failure_count_90d": 0.6,
    "days_since_last_txn": 0.01,
    "tenure_days": -0.0001,
}
INTERCEPT = -0.3


def scored(t: Tables) -> DataFrame:
    """Every member scored; attributions and uplift for the high-risk ones only."""
    names = tuple(WEIGHTS)
    probability = round_to(scoring.linear_score(WEIGHTS, INTERCEPT), 6)
    flagged = (
        t.mart.selectExpr("msno", *scoring.feature_columns(t.mart, names))
        .selectExpr("*", f"{probability} AS churn_prob")
        .selectExpr("*", f"{scoring.churn_flag('churn_prob', CFG)} AS churn_flag")
    )
    explained = scoring.linear_attributions(flagged, WEIGHTS, "churn_flag = 1")
    return explained.selectExpr(
        "msno",
        "churn_prob",
        "churn_flag",
        *[f"{round_to(f'shap_{c}', 6)} AS shap_{c}" for c in names],
        "CASE WHEN churn_flag = 1 THEN (CAST(msno AS BIGINT) % 17 - 4) / 100D END AS uplift_score",
    )


def replies(t: Tables) -> DataFrame:
    """Model replies of every kind: tagged fence, bare JSON, plain fence, no JSON at all."""
    names = ", ".join(f"'{a}'" for a in (*INTERVENTION_TYPES, "call_a_friend"))
    body = f"""'{{"explanation": "User ' || msno || ' may leave.", "recommended_action": "'
        || elt(CAST(CAST(msno AS BIGINT) % 5 AS INT) + 1, {names})
        || '", "action_justification": "Segment ' || registered_via || '."}}'"""
    text = f"""CASE CAST(msno AS BIGINT) % 4
        WHEN 0 THEN '```json\\n' || {body} || '\\n```'
        WHEN 1 THEN '  ' || {body}
        WHEN 2 THEN '```\\n' || {body} || '\\n```'
        ELSE 'Sorry, user ' || msno || ' is unclear' END"""
    return t.raw["raw_members"].selectExpr("msno", f"{text} AS reply")


def plan(t: Tables) -> DataFrame:
    return actions.select_interventions(scored(t), explain.parse_replies(replies(t)), CFG)


register("scored_linear", stage=keep_mart)(lambda t: scored(t).select("msno", "churn_prob", "churn_flag"))
register("linear_attributions", stage=keep_mart)(scored)
register(
    "high_risk_summary",
    "SELECT count(*) AS scored_users, CAST(sum(churn_flag) AS BIGINT) AS high_risk_users, "
    "CAST(sum(churn_flag) AS DOUBLE) / count(*) AS high_risk_share FROM scored_linear",
    stage=keep_mart,
)(lambda t: scoring.high_risk_summary(scored(t)))


def _flat(frame: DataFrame, factors: str) -> DataFrame:
    """One row per user and factor, numbered from 1."""
    listed = frame.selectExpr("msno", f"posexplode({factors}) AS (i, f)")
    return listed.selectExpr("msno", "i + 1 AS position", "f.*")


@register("top_factors", stage=keep_mart)
def top_factors(t: Tables) -> DataFrame:
    frame = scored(t)
    return _flat(frame, explain.top_factors(frame, CFG.top_factors))


@register("labelled_factors", stage=keep_mart)
def labelled_factors(t: Tables) -> DataFrame:
    frame = scored(t)
    return _flat(frame, explain.labelled_factors(frame, CFG.top_factors))


register("narration_candidates", stage=keep_mart)(
    lambda t: explain.narration_candidates(scored(t), CFG).select("msno", "churn_prob")
)


@register("prompts", stage=keep_mart)
def prompts(t: Tables) -> DataFrame:
    engagement = features.intervention_engagement(t.interventions)
    context = t.mart.join(engagement, "msno", "left")
    flagged = scored(t).filter("churn_flag = 1")
    return explain.prompts(flagged, t.change_points, context, CFG)


def _breaking_off(after: int) -> Callable[[DataFrame], DataFrame]:
    """A narrator that fails once it has answered so many batches."""
    answered = []

    def narrator(asked: DataFrame) -> DataFrame:
        if len(answered) == after:
            raise ConnectionError("no answer")
        answered.append(asked)
        return _repeating(asked)

    return narrator


def _repeating(asked: DataFrame) -> DataFrame:
    """Replies that repeat the second line of the prompt."""
    line = "get(split(prompt, '\\n'), 1)"
    fields = f"'explanation', {line}, 'recommended_action', 'no_action', 'action_justification', 'repeated'"
    return asked.selectExpr("msno", f"to_json(map({fields})) AS reply")


@register(
    "resumed_replies",
    """SELECT msno, string_split(prompt, chr(10))[2] AS explanation, 'no_action' AS recommended_action,
              'repeated' AS action_justification FROM prompts""",
    stage=keep_mart,
)
def resumed_replies(t: Tables) -> DataFrame:
    """Narratives after a run that broke off between batches and a second one for the rest."""
    store = f"{shared_dir(t.mart.sparkSession)}/{uuid.uuid4().hex}"
    asked = settle(prompts(t))
    rows = max(1, asked.count() // 8)
    try:
        narration.replies_to(asked, _breaking_off(3), store, rows, attempts=1)
    except ConnectionError:
        pass
    return explain.parse_replies(narration.replies_to(asked, _repeating, store, rows))


register("template_narrative", stage=keep_mart)(lambda t: explain.template_narrative(scored(t), t.change_points))
register("parsed_replies")(lambda t: explain.parse_replies(replies(t)))
register("action_plan", stage=keep_mart)(plan)
register("plan_kpis", stage=keep_mart)(lambda t: actions.plan_kpis(plan(t)))
register("top_plan", stage=keep_mart)(lambda t: actions.top_plan(plan(t)))


def _segments(t: Tables, segment: str) -> DataFrame:
    return _rounded(actions.segment_summary(plan(t), t.mart, segment), 8, "avg_churn_prob")


SEGMENTS = {"segment_by_tier": "risk_tier", "segment_by_cohort": "behavioral_cohort"}
for _name, _segment in SEGMENTS.items():
    register(_name, oracle.segment_sql(_segment), stage=keep_mart)(
        lambda t, segment=_segment: _segments(t, segment)
    )


@register("risk_lookup", stage=keep_mart)
def risk_lookup(t: Tables) -> DataFrame:
    """Records for every log user plus keys nobody has."""
    users = t.raw["raw_user_logs"].select("msno")
    unknown = users.select(F.concat(F.lit("x"), "msno").alias("msno"))
    blank = users.select(F.lit(" ").alias("msno"))
    frame = scored(t)
    found = actions.risk_lookup(
        users.unionByName(unknown).unionByName(blank),
        frame,
        explain.template_narrative(frame, t.change_points),
        t.change_points,
    )
    named = "transform(top_risk_factors, f -> f.feature || ':' || f.direction)"
    return found.withColumn("top_risk_factors", F.expr(f"array_join({named}, ',')"))


# ---- measurement and profiles ----------------------------------------------------------

register("save_rate")(lambda t: actions.save_rate(t.outcomes))
register("churn_rate")(lambda t: profile.churn_rate(t.mart))
register("target_distribution")(lambda t: profile.target_distribution(t.mart))
register("churn_by_tier")(lambda t: profile.churn_by_tier(t.mart))


@register("feature_summary", stage=keep_mart)
def feature_summary(t: Tables) -> DataFrame:
    return _rounded(profile.feature_summary(t.mart), 5, "mean", "std", "p25", "p50", "p75")


@register("feature_histogram", stage=keep_mart)
def feature_histogram(t: Tables) -> DataFrame:
    return _rounded(profile.feature_histogram(t.mart), 6, "bin_start")


# ---- model evaluation ------------------------------------------------------------------


def labelled_scores(t: Tables) -> DataFrame:
    labels = t.mart.select("msno", "is_churn").filter(F.col("is_churn").isNotNull())
    return scored(t).select("msno", "churn_prob").join(labels, "msno")


register("class_weight")(lambda t: evaluation.class_weight(t.mart))


@register("stratified_split", stage=keep_mart)
def stratified_split(t: Tables) -> DataFrame:
    labelled = t.mart.filter(F.col("is_churn").isNotNull())
    draw = "(CAST(msno AS BIGINT) * 7919 + 42) % 1009"
    return evaluation.stratified_split(labelled, draw)


register("auc_roc", stage=keep_mart)(lambda t: _rounded(evaluation.auc_roc(labelled_scores(t)), 9, "auc_roc"))
register("average_precision", stage=keep_mart)(
    lambda t: _rounded(evaluation.average_precision(labelled_scores(t)), 9, "average_precision")
)
register("roc_points", stage=keep_mart)(lambda t: evaluation.roc_points(labelled_scores(t)))
register("pr_points", stage=keep_mart)(lambda t: evaluation.pr_points(labelled_scores(t)))

# ---- drift -----------------------------------------------------------------------------


def train_and_score(t: Tables) -> tuple[DataFrame, DataFrame]:
    return t.mart.filter(F.col("split") == "train"), t.mart


@register("psi_by_feature", stage=keep_mart)
def psi_by_feature(t: Tables) -> DataFrame:
    return _rounded(drift.psi_by_feature(*train_and_score(t), CFG), 9, "psi")


@register("ks_by_feature", stage=keep_mart)
def ks_by_feature(t: Tables) -> DataFrame:
    return _rounded(drift.ks_by_feature(*train_and_score(t)), 9, "ks_statistic")


@register("psi_from_profile", oracle.BLOCKS["psi_by_feature"], stage=keep_mart)
def psi_from_profile(t: Tables) -> DataFrame:
    """The index against a profile that was stored in two parts."""
    train, score = train_and_score(t)
    parts = [settle(drift.reference_profile(train.filter(f"hash(msno) % 2 {sign} 0"))) for sign in ("=", "<>")]
    return _rounded(drift.psi_against(drift.merged_profiles(*parts), score, CFG), 9, "psi")


@register("ks_from_profile", oracle.BLOCKS["ks_by_feature"], stage=keep_mart)
def ks_from_profile(t: Tables) -> DataFrame:
    train, score = train_and_score(t)
    return _rounded(drift.ks_against(settle(drift.reference_profile(train)), score), 9, "ks_statistic")


register("drift_summary", stage=keep_mart)(
    lambda t: drift.drift_summary(drift.psi_by_feature(*train_and_score(t), CFG), CFG)
)


@register("retrain_decision", stage=keep_mart)
def retrain_decision(t: Tables) -> DataFrame:
    report = drift.drift_summary(drift.psi_by_feature(*train_and_score(t), CFG), CFG)
    return report.select(F.col("retraining_recommended").alias("retrain"))


# ---- attributions of a forest given by its leaves ---------------------------------------

FOREST_FEATURES = ("login_days_last_30d", "ticket_count_30d", "tenure_days")
# Two trees: logins up to 5, then tickets up to 0; and tenure up to 365 days. Per leaf its
# value and, per feature, the interval that passes and the share of rows it covers.
FOREST = [
    treeshap.Leaf(value, *map(np.array, zip(*path)))
    for value, path in (
        (0.2, [(0, -np.inf, 5.0, 0.4), (1, -np.inf, 0.0, 0.75)]),
        (0.9, [(0, -np.inf, 5.0, 0.4), (1, 0.0, np.inf, 0.25)]),
        (-0.5, [(0, 5.0, np.inf, 0.6)]),
        (0.3, [(2, -np.inf, 365.0, 0.3)]),
        (-0.1, [(2, 365.0, np.inf, 0.7)]),
    )
]


@register("forest_attributions", stage=keep_mart)
def forest_attributions(t: Tables) -> DataFrame:
    rows = t.mart.selectExpr("msno", *scoring.feature_columns(t.mart, FOREST_FEATURES))
    found = treeshap.tree_attributions(rows, FOREST, FOREST_FEATURES, "msno")
    return _rounded(found, 9, *[f"shap_{f}" for f in FOREST_FEATURES])


# ---- learned models (no oracle: rows and invariants only) ------------------------------

# ``churn_gbt_scores`` and ``cv_metrics`` fit the published model. The queries after them start, as
# the scoring pipeline does, from stored models: an application fits them once per input.

PARAMS = models.BoostingParams()
STORED: dict[tuple[str, str], tuple[models.TrainedModel, ...]] = {}

register("churn_gbt_scores", stage=keep_marts)(
    lambda t: models.score_users(t.mart, models.train_churn(t.mart, PARAMS), CFG)
)
register("cv_metrics", stage=keep_marts)(lambda t: models.cross_validate(t.mart, PARAMS))


def stored_models(t: Tables) -> tuple[models.TrainedModel, ...]:
    """Churn, treated and control model of the published size, fitted together."""
    spark = t.mart.sparkSession
    name = (spark.sparkContext.applicationId, t.raw.sf_dir)
    if name not in STORED:
        fits = [models.churn_fit(t.mart), *models.uplift_fits(t.intervention_mart)]
        STORED[name] = tuple(models.trained(fits, PARAMS))
    return STORED[name]


@register("feature_importance", stage=keep_marts)
def feature_importance(t: Tables) -> DataFrame:
    return models.feature_importance(t.mart.sparkSession, stored_models(t)[0])


@register("tree_attributions", stage=keep_marts)
def tree_attributions(t: Tables) -> DataFrame:
    return models.score_and_explain(t.mart, stored_models(t)[0], CFG)


@register("booster_invariants", stage=keep_marts)
def booster_invariants(t: Tables) -> DataFrame:
    """What must hold for every user whatever the booster has learned."""
    model, *pair = stored_models(t)
    scored = models.score_and_explain(t.mart, model, CFG, tuple(pair))
    base = treeshap.base_value(treeshap.leaves_of(model.booster))
    names = explain.attribution_columns(scored)
    gap = f"abs({' + '.join(names)} + {base}D - ln(churn_prob / (1D - churn_prob)))"
    return scored.selectExpr(
        "msno",
        f"(churn_flag = 1) = (churn_prob >= {CFG.churn_threshold}D) AS flag_fits",
        "churn_prob > 0 AND churn_prob < 1 AS is_probability",
        f"CASE WHEN churn_flag = 1 THEN {gap} < 1e-6 ELSE {names[0]} IS NULL END AS adds_up",
        "(churn_flag = 1) = (uplift_score IS NOT NULL) AS uplift_where_flagged",
    )


def _with_uplift(t: Tables) -> DataFrame:
    churn, *pair = stored_models(t)
    return models.score_and_explain(t.mart, churn, CFG, tuple(pair))


register("uplift_scores", stage=keep_marts)(
    lambda t: _with_uplift(t).select("msno", "churn_prob", "churn_flag", "uplift_score")
)
register("uplift_summary", stage=keep_marts)(
    lambda t: models.uplift_summary(_with_uplift(t), CFG)
)


# ---- sources, exports and pipelines over CSV files of the raw tables --------------------


def _spoilt_members(raw: DataFrame) -> DataFrame:
    """Lines of a members file, six of eleven spoilt in one way or written unusually."""
    kind = "CAST(msno AS BIGINT) % 11"
    names = "msno,city,bd,gender,registered_via,registration_init_time"
    cells = {n: f"coalesce(CAST({n} AS STRING), '')" for n in names.split(",")}
    cells["msno"] = f"CASE {kind} WHEN 5 THEN '  ' WHEN 6 THEN '' ELSE msno END"
    cells["city"] = f"if({kind} = 0, 'x', {cells['city']})"
    cells["bd"] = f"concat({cells['bd']}, CASE {kind} WHEN 1 THEN '.0' WHEN 2 THEN '.5' ELSE '' END)"
    last = cells.pop("registration_init_time")
    end = f"CASE {kind} WHEN 3 THEN '' WHEN 4 THEN concat(',', {last}, ',9') ELSE concat(',', {last}) END"
    return raw.selectExpr(f"concat(concat_ws(',', {', '.join(cells.values())}), {end}) AS `{names}`")


def _spoilt_folder(t: Tables) -> str:
    """A folder with a members file of spoilt lines and labels under their second name."""
    spark = t.raw.spark
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    lines = _spoilt_members(t.raw["raw_members"])
    # The separator does not occur, so that lines are written as they are.
    lines.write.option("header", True).option("sep", "\u0001").csv(f"{folder}/members_v3.csv")
    export(t.raw["raw_train"].select(*RAW_TABLES["raw_train"].schema.names), f"{folder}/train.csv", "csv")
    return folder


@register("loaded_members")
def loaded_members(t: Tables) -> DataFrame:
    """Usable lines of a CSV file."""
    return readers.load_raw_tables(t.raw.spark, *[_spoilt_folder(t)] * 2)["raw_members"]


@register("load_report")
def load_report(t: Tables) -> DataFrame:
    """Lines by reason of every table that has a file."""
    spark, folder = t.raw.spark, _spoilt_folder(t)
    graded = {name: readers.graded_table(spark, folder, name) for name in RAW_TABLES}
    reports = [
        readers.line_report(g).select(F.lit(name).alias("table_name"), "reason", "lines")
        for name, g in graded.items()
        if g is not None
    ]
    return reduce(DataFrame.unionByName, reports)


JOBS: dict[tuple[str, str], pipelines.Job] = {}


def job_of(t: Tables) -> pipelines.Job:
    """A feature run over CSV files of the raw tables; an application runs it once per input."""
    spark = t.raw.spark
    name = (spark.sparkContext.applicationId, t.raw.sf_dir)
    if name not in JOBS:
        folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
        for table, spec in RAW_TABLES.items():
            export(t.raw[table].select(*spec.schema.names), f"{folder}/raw/{spec.files[-1]}", "csv")
        job = pipelines.Job(f"{folder}/raw", f"{folder}/raw", f"{folder}/out", CFG, PARAMS, run="only")
        pipelines.run_features(spark, job)
        JOBS[name] = job
    return JOBS[name]


# What hangs on the order of payments of one day, which a hash of the row decides where the
# files hold no other order.
TIED = ("auto_renew_flag", "plan_downgrade_flag", "membership_expire_days")


@register("exported_features")
def exported_features(t: Tables) -> DataFrame:
    """The whole mart on the change points that are found, from CSV files to the export."""
    return readers.read_export(t.raw.spark, job_of(t).path("features_score")).drop(*TIED)


@register("exported_train")
def exported_train(t: Tables) -> DataFrame:
    return readers.read_export(t.raw.spark, job_of(t).path("features_train")).drop(*TIED)


@register("exported_change_points")
def exported_change_points(t: Tables) -> DataFrame:
    """Exported change points; a path without an export adds the rows of an empty table."""
    spark, job = t.raw.spark, job_of(t)
    found = readers.load_change_points(spark, job.path("change_points"))
    return found.unionByName(readers.load_change_points(spark, job.path("not_there")))


@register("exported_plan", stage=keep_mart)
def exported_plan(t: Tables) -> DataFrame:
    """The action plan after an export that replaces an earlier one."""
    path = f"{shared_dir(t.raw.spark)}/{uuid.uuid4().hex}"
    export(plan(t).limit(0), path)
    export(plan(t), path)
    return readers.read_export(t.raw.spark, path)


@register("feature_load_report")
def feature_load_report(t: Tables) -> DataFrame:
    """What loading an export reports when half of its rows lack a key."""
    spark = t.raw.spark
    rows = t.raw["raw_members"]
    blank = rows.withColumn("msno", F.when(F.length("msno") % 2 == 0, F.lit("  ")))
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    export(rows.unionByName(blank), path)
    kept, seen = readers.load_features(spark, path)
    counted = (kept.count(), seen.get)
    row = (counted[1]["rows_read"], counted[1]["rows_dropped"], counted[0])
    return spark.createDataFrame([row], "rows_read bigint, rows_dropped bigint, rows_kept bigint")


@register("exported_scores", stage=keep_marts)
def exported_scores(t: Tables) -> DataFrame:
    """Invariants of the scoring run's export, with models stored and loaded as one set."""
    spark, job = t.raw.spark, job_of(t)
    names = ("churn_classifier", "uplift_treatment", "uplift_control")
    models.save_models(job.model_dir, dict(zip(names, stored_models(t))))
    scored_users = pipelines.score(spark, job)
    first = explain.attribution_columns(scored_users)[0]
    return scored_users.selectExpr(
        "msno",
        f"(churn_flag = 1) = (churn_prob >= {CFG.churn_threshold}D) AS flag_fits",
        "churn_prob > 0 AND churn_prob < 1 AS is_probability",
        f"(churn_flag = 1) = ({first} IS NOT NULL) AS explained_where_flagged",
        "(churn_flag = 1) = (uplift_score IS NOT NULL) AS uplift_where_flagged",
    )
