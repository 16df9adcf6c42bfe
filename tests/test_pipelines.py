import dataclasses
import json
from pathlib import Path

import pytest
from pyspark.sql import Observation, functions as F

from staywise.config import EngineConfig
from staywise.operators import models
from staywise.plans import pipelines
from staywise.sources import readers, testdata
from staywise.sources.schemas import MEMBERS, RAW_TABLES
from staywise.sources.writers import export, read_stage, replace_stage, settle, shared_dir

SMALL = "/root/testdata/sf0.001"


def test_csv_by_header_skips_malformed_and_blank_keys(spark, tmp_path):
    (tmp_path / "members_v3.csv").write_text(
        "msno,city,bd,gender,registered_via,registration_init_time,extra\n"
        "a+/=,1,20,male,3,20170101,x\n"
        "b,notanumber,20,male,3,20170101,x\n"
        " ,1,20,male,3,20170101,x\n"
        ",1,20,male,3,20170101,x\n"
        "c,2,,,4,20170102,x\n"
    )
    out = readers.load_table(spark, str(tmp_path), "raw_members")
    assert out.schema == MEMBERS
    assert sorted(r["msno"] for r in out.collect()) == ["a+/=", "c"]
    assert out.select("msno").count() == out.filter("gender = 'male' OR gender IS NULL").count() == 2
    assert readers.load_table(spark, str(tmp_path), "raw_train") is None
    (tmp_path / "train.csv").write_text("msno,is_churn\na,1\n")
    assert readers.load_table(spark, str(tmp_path), "raw_train").count() == 1


def test_lines_are_accounted_for(spark, tmp_path):
    """Counts per reason come with the load; whole numbers may carry a fraction of zero."""
    (tmp_path / "members_v3.csv").write_text(
        "msno,city,bd,gender,registered_via,registration_init_time\n"
        "a,1,20.0,male,3,20170101\n"
        "b,x,20,male,3,20170101\n"
        "c,1,20.5,male,3,20170101\n"
        "d,1,20,male,3\n"
        "e,1,20,male,3,20170101,9\n"
        " ,1,20,male,3,20170101\n"
        ",1,20,male,3,20170101\n"
        "f,1,,,3,20170101\n"
    )
    seen = Observation("members")
    rows = readers.load_table(spark, str(tmp_path), "raw_members", seen).collect()
    assert [(r["msno"], r["bd"]) for r in rows] == [("a", 20), ("f", None)]
    assert seen.get == {"lines": 8, "fields": 2, "type": 2, "key": 2}
    graded = readers.graded_table(spark, str(tmp_path), "raw_members")
    assert dict(readers.line_report(graded).collect()) == {"used": 2, "fields": 2, "type": 2, "key": 2}
    kept = {r["line"]: r["reason"] for r in readers.quarantine(graded).collect()}
    assert kept["b,x,20,male,3,20170101"] == "type" and kept["e,1,20,male,3,20170101,9"] == "fields"


def failing(spark):
    """A table whose last partition cannot be written."""
    return spark.range(0, 8, 1, 4).selectExpr("if(id = 7, CAST(raise_error('stop') AS BIGINT), id) AS n")


def test_failed_writes_leave_the_old_version(spark, tmp_path):
    stage, out = str(tmp_path / "stage"), str(tmp_path / "out")
    replace_stage(spark.range(3).toDF("n"), stage)
    export(spark.range(3).toDF("n"), out)
    for write in (lambda f: replace_stage(f, stage), lambda f: export(f, out)):
        with pytest.raises(Exception, match="stop"):
            write(failing(spark))
        assert read_stage(spark, stage).count() == spark.read.parquet(out).count() == 3
    begun = read_stage(spark, stage)
    replace_stage(spark.range(5).toDF("n"), stage)
    export(spark.read.parquet(out).selectExpr("n + 1 AS n"), out)  # may read what it replaces
    assert begun.count() == 3 and read_stage(spark, stage).count() == 5
    assert sorted(r["n"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]
    for k in range(3):
        replace_stage(spark.range(k).toDF("n"), stage)
    assert read_stage(spark, stage).count() == 2 and len(list(Path(stage).glob("v-*"))) == 2
    with pytest.raises(FileNotFoundError):
        read_stage(spark, str(tmp_path / "none"))
    assert {p.name for p in tmp_path.iterdir()} == {"stage", "out"}


def test_a_run_started_again_goes_on_behind_its_stages(spark, tmp_path):
    path, calls = str(tmp_path / "stage"), spark.sparkContext.accumulator(0)
    rows = spark.range(4).rdd.map(lambda r: calls.add(1) or (r[0],)).toDF("n bigint")
    first = replace_stage(rows, path, run="monday")
    assert calls.value == 4
    assert replace_stage(rows, path, run="monday").collect() == first.collect() and calls.value == 4
    replace_stage(rows, path, run="tuesday")
    assert calls.value == 8


def test_models_are_replaced_as_one_set(spark, tmp_path):
    """A crash between two models leaves the set of before; names of before do not stay behind."""
    frame = spark.createDataFrame([(f"u{i}", float(i % 7), i % 2) for i in range(60)], "msno string, a double, is_churn int")
    old = models.train_churn(frame, models.BoostingParams(trees=1, depth=1, min_rows=1), ("a",))
    new = models.train_churn(frame, models.BoostingParams(trees=2, depth=1, min_rows=1), ("a",))
    folder = str(tmp_path / "models")
    models.save_models(folder, {"churn": old, "uplift": old})

    class Broken(models.TrainedModel):
        @property
        def pipeline(self):
            raise OSError("disk is full")

        @pipeline.setter
        def pipeline(self, value):
            pass

    broken = object.__new__(Broken)
    with pytest.raises(OSError):
        models.save_models(folder, {"churn": new, "uplift": broken})
    assert models.load_model(folder, "churn").booster.getNumTrees == models.load_model(folder, "uplift").booster.getNumTrees == 1
    models.save_models(folder, {"churn": new})
    assert models.load_model(folder, "churn").booster.getNumTrees == 2 and models.load_model(folder, "uplift") is None


def test_samples(spark):
    users = spark.range(1000).selectExpr("CAST(id AS STRING) AS msno")
    picked = readers.sample_users(users, 50)
    assert picked.count() == 50 and picked.collect() == readers.sample_users(users, 50).collect()
    logs = users.crossJoin(spark.range(2).toDF("n"))
    assert readers.rows_of_users(logs, picked).count() == 100


def test_ad_hoc_sql(spark):
    frame = spark.range(10)
    assert readers.run_sql(spark, "SELECT count(*) AS n FROM {t} WHERE id > :low", {"low": 3}, t=frame).first()["n"] == 6


def test_settled_rows_stay(spark):
    frame = settle(spark.range(100).withColumn("r", F.rand()))
    assert frame.collect() == frame.collect()


def test_shared_folder_must_be_configured(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert shared_dir(spark).startswith(named)
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    with pytest.raises(RuntimeError):
        shared_dir(spark)


def test_change_points_default_to_an_empty_table(spark, tmp_path):
    assert readers.load_change_points(spark, str(tmp_path / "none")).count() == 0
    assert readers.load_change_points(spark, None).columns[1] == "change_point_detected"


@pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")
def test_full_run_from_csv(spark, tmp_path):
    core, saas = tmp_path / "core", tmp_path / "saas"
    raw = testdata.RawTables(spark, SMALL)
    for name, spec in RAW_TABLES.items():
        folder = core if name in pipelines.REQUIRED else saas
        export(raw[name].select(*spec.schema.names), str(folder / spec.files[0]), "csv")
    cfg = EngineConfig(ref_date=testdata.TEST_CONFIG.ref_date, churn_threshold=0.3, uplift_min=-1.0)
    params = models.BoostingParams(trees=3, depth=3, rate=0.3, min_rows=2)
    job = pipelines.Job(str(core), str(saas), str(tmp_path / "out"), cfg, params, folds=2, hand_off="csv")

    assert drift_needed(spark, job)
    plan = pipelines.run_full(spark, job)
    rows = plan.collect()
    assert rows and {r["final_action"] for r in rows} <= {"personal_outreach", "no_action"}
    assert spark.read.parquet(job.path("features_score")).count() == raw["raw_members"].count()
    assert spark.read.parquet(job.path("features_train")).count() == raw["raw_train"].count()

    facts = models.load_metadata(job.model_dir, "churn_classifier")["facts"]
    assert {"holdout_auc_roc", "holdout_average_precision", "cv_mean_auc_pr"} <= set(facts)
    assert all(0 <= float(v) <= 1 for k, v in facts.items() if k != "trees")
    handed = spark.read.option("header", True).csv(job.path("action_plan_csv"))
    assert handed.count() == len(rows) and handed.columns == plan.columns
    tables = pipelines.segment_tables(spark, job)
    assert sum(r[1] for r in tables["risk_tier"].collect()) == sum(r[1] for r in tables["behavioral_cohort"].collect())
    keys = plan.select("msno").limit(3).unionByName(spark.createDataFrame([("nobody",)], "msno string"))
    assert pipelines.lookup(spark, job, keys).count() == 3
    assert pipelines.distribution_report(spark, job).count() == 40

    # Prompts out, replies in.
    def narrator(prompts):
        reply = json.dumps({"explanation": "e", "recommended_action": "discount_offer", "action_justification": "j"})
        return prompts.select("msno", F.lit(f"```json\n{reply}\n```").alias("reply"))

    scored = readers.read_export(spark, job.path("scored_users"))
    plan = pipelines.plan_actions(spark, job, scored, narrator)
    assert {r["final_action"] for r in plan.collect()} == {"discount_offer"}

    # A narrator with a limit: everyone else gets the template.
    few = dataclasses.replace(job, narrated=1)
    actions_of = [r["final_action"] for r in pipelines.plan_actions(spark, few, scored, narrator).collect()]
    assert len(actions_of) == len(rows) > 2
    assert actions_of.count("discount_offer") == 1 and actions_of.count("personal_outreach") == len(rows) - 1

    same = pipelines.drift_report(spark, job, job.path("features_score"), job.path("features_score")).first()
    assert not same["retraining_recommended"]
    report = pipelines.drift_report(spark, job).first()
    assert report["total_features"] == 40
    assert pipelines.run_retraining(spark, job) == report["retraining_recommended"]

    # Without uplift models scoring goes on with NULL uplift.
    lone = pipelines.Job(str(core), str(saas), str(tmp_path / "lone"), cfg, params)
    pipelines.run_features(spark, lone)
    churn = models.load_model(job.model_dir, "churn_classifier")
    models.save_model(churn, lone.model_dir, "churn_classifier")
    assert pipelines.score(spark, lone).filter("uplift_score IS NOT NULL").count() == 0


def drift_needed(spark, job):
    from staywise.operators.drift import should_retrain

    return should_retrain(lambda: pipelines.drift_report(spark, job))


def scanned_rows(frame):
    """Rows that the scans of an executed plan gave out."""
    plan = frame._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    nodes, total = [plan], 0
    while nodes:
        node = nodes.pop()
        if "Scan" in node.nodeName():
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_lookup_reads_what_may_hold_the_keys(spark, tmp_path):
    """Sorted files with Bloom filters: few keys read few rows, many keys are joined."""
    users = spark.range(200_000, numPartitions=8).selectExpr("CAST(xxhash64(id) AS STRING) AS msno", "id AS value")
    export(users, str(tmp_path / "users"), key="msno")
    stored = readers.read_export(spark, str(tmp_path / "users"))
    keys = users.filter("value % 100000 = 7").select("msno").union(spark.createDataFrame([("nobody",), (None,)], "msno string"))
    found = readers.rows_of_keys(stored, keys)
    assert sorted(r["value"] for r in found.collect()) == [7, 100_007]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scanned_rows(readers.rows_of_keys(stored, keys)) <= 50_000  # two files of eight at most
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    many = users.filter("value < 3000").select("msno")
    assert readers.rows_of_keys(stored, many).count() == 3000


def test_large_samples_are_exact(spark, monkeypatch):
    """Cut by ranges of the hash or merged in one task: the same users, also where all tie."""
    users = spark.range(30_000).selectExpr("CAST(id % 20000 AS STRING) AS msno")
    for n in (0, 1, 777, 15_000, 29_999, 30_000, 40_000):
        merged = sorted(r[0] for r in readers.sample_users(users, n).collect())
        monkeypatch.setattr(readers, "MERGED_SAMPLE", -1)
        assert sorted(r[0] for r in readers.sample_users(users, n).collect()) == merged and len(merged) == min(n, 30_000)
        monkeypatch.undo()
    monkeypatch.setattr(readers, "MERGED_SAMPLE", -1)
    assert readers.sample_users(users.selectExpr("'same' AS msno"), 12_345).count() == 12_345
    assert readers.sample_users(users.limit(0), 5).count() == 0
