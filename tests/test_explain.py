import json

import pytest

from staywise.config import EngineConfig
from staywise.operators import actions, explain
from staywise.sources.schemas import CHANGE_POINTS

CFG = EngineConfig()
SCHEMA = (
    "msno string, churn_prob double, churn_flag int, shap_usage_decay_30d double, "
    "shap_ticket_count_30d double, shap_city_encoded double, shap_tenure_days double, uplift_score double"
)


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        ("a", 0.875, 1, 0.1, -0.5, None, 0.3, 0.2),
        ("b", 0.7, 1, 0.2, 0.2, 0.2, 0.2, 0.04),
        ("c", 0.1, 0, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def shifts(spark):
    from datetime import date

    rows = [("a", True, date(2017, 3, 1), 12, 0.0, 1.0, 0.5, -0.425)]
    return spark.createDataFrame(rows, CHANGE_POINTS)


def test_factors_by_size_without_nulls(scored):
    rows = {r["msno"]: r["f"] for r in scored.selectExpr("msno", f"{explain.top_factors(scored, 2)} AS f").collect()}
    assert [tuple(x) for x in rows["a"]] == [
        ("ticket_count_30d", -0.5, "risk_decrease"),
        ("tenure_days", 0.3, "risk_increase"),
    ]
    assert [x["feature"] for x in rows["b"]] == ["usage_decay_30d", "ticket_count_30d"]
    assert rows["c"] == []


def test_labels(scored):
    row = scored.filter("msno = 'b'").selectExpr(f"{explain.labelled_factors(scored, 4)} AS f").first()["f"]
    assert [x["label"] for x in row] == [
        "30-day usage decay", "support tickets (last 30 days)", "city encoded", "tenure days",
    ]
    assert row[0]["impact"] == "increases churn risk"


def test_prompt(spark, scored, shifts):
    context = spark.createDataFrame([("a", 30, 1)], "msno string, tenure_days int, plan_downgrade_flag int")
    out = explain.prompts(explain.narration_candidates(scored, CFG), shifts, context, CFG)
    texts = {r["msno"]: r["prompt"] for r in out.collect()}
    assert set(texts) == {"a", "b"}
    assert "Churn probability: 88%" in texts["a"]
    assert "- support tickets (last 30 days): decreases churn risk (magnitude: 0.500)" in texts["a"]
    assert "12 days back, on 2017-03-01: -42% against the level before." in texts["a"]
    assert "Tenure: 30 days" in texts["a"] and "opened=N/A" in texts["a"]
    assert "another level" not in texts["b"] and "Tenure: unknown days" in texts["b"]


def test_narration_cap(spark):
    rows = [(f"u{i}", 0.9 + i / 1e4, 1) for i in range(300)]
    frame = spark.createDataFrame(rows, "msno string, churn_prob double, churn_flag int")
    kept = explain.narration_candidates(frame, CFG).collect()
    assert len(kept) == 200 and kept[0]["msno"] == "u299"


def test_replies(spark):
    good = {"explanation": "why", "recommended_action": "discount_offer", "action_justification": "so"}
    body = json.dumps(good)
    replies = {
        "plain": body,
        "padded": f"\n  {body} ",
        "tagged": f"```json\n{body}\n```",
        "fenced": f"```\n{body}\n```",
        "garbage": "I cannot help",
        "cut": body[:-5],
        "number": "3",
        "partial": json.dumps({"explanation": "why"}),
        "null": None,
    }
    frame = spark.createDataFrame(list(replies.items()), "msno string, reply string")
    got = {r["msno"]: r.asDict() for r in explain.parse_replies(frame).collect()}
    for name in ("plain", "padded", "tagged", "fenced"):
        assert got[name] == {"msno": name, **good}
    for name in ("garbage", "cut", "number", "null"):
        assert got[name] == {"msno": name, **explain.UNREADABLE}
    assert got["partial"]["explanation"] == "why" and got["partial"]["recommended_action"] is None


def test_template_narrative(scored, shifts):
    got = {r["msno"]: r for r in explain.template_narrative(scored, shifts).collect()}
    assert "weighs most is ticket count 30d;" in got["a"]["explanation"]
    assert got["a"]["explanation"].endswith("Use shifted on 2017-03-01.")
    assert got["c"]["recommended_action"] == "no_action"


def test_final_action(spark):
    rows = [(None, "discount_offer"), (0.04, "discount_offer"), (0.05, "discount_offer"), (0.05, "call_a_friend"), (0.05, None)]
    frame = spark.createDataFrame(rows, "uplift_score double, recommended_action string")
    got = [r[0] for r in frame.selectExpr(actions.final_action(CFG)).collect()]
    assert got == ["no_action", "no_action", "discount_offer", "no_action", "no_action"]


def test_plan_and_lookup(spark, scored, shifts):
    narratives = explain.template_narrative(scored, shifts)
    plan = actions.select_interventions(scored, narratives, CFG)
    assert {r["msno"]: r["final_action"] for r in plan.collect()} == {"a": "personal_outreach", "b": "no_action"}
    assert tuple(actions.plan_kpis(plan).first()) == (2, 1, 50.0)
    assert tuple(actions.plan_kpis(plan.limit(0)).first()) == (0, 0, None)
    segments = spark.createDataFrame([("a", "high"), ("b", None)], "msno string, risk_tier string")
    assert [tuple(r) for r in actions.segment_summary(plan, segments, "risk_tier").collect()] == [("high", 1, 0.875, 100.0)]
    keys = spark.createDataFrame([("a",), ("a",), ("zzz",), (" ",), (None,)], "msno string")
    found = actions.risk_lookup(keys, scored, narratives, shifts).collect()
    assert len(found) == 1 and found[0]["change_point_date"] == "2017-03-01"
    assert len(found[0]["top_risk_factors"]) == 3


def test_save_rate(spark):
    rows = [("no_treatment", False), ("no_treatment", True), ("discount_offer", True)]
    frame = spark.createDataFrame(rows, "intervention_type string, was_saved boolean")
    assert tuple(actions.save_rate(frame).first()) == (1.0, 0.5, 0.5)
