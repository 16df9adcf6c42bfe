"""Replies are asked for once, in batches, and survive a run that breaks off."""

import pytest
from pyspark.sql import functions as F

from staywise.operators import narration


class Service:
    """Answers with the prompt's text; fails on the calls given by number."""

    def __init__(self, fails=()):
        self.fails, self.calls, self.asked = set(fails), 0, []

    def __call__(self, prompts):
        self.calls += 1
        if self.calls in self.fails:
            raise ConnectionError("no answer")
        self.asked.append([r["prompt"] for r in prompts.collect()])
        return prompts.select("msno", F.concat(F.lit("re: "), "prompt").alias("reply"))


@pytest.fixture()
def prompts(spark):
    rows = [(f"u{i}", f"text {i % 40}") for i in range(60)] + [("none", None), (None, "text 0")]
    return spark.createDataFrame(rows, "msno string, prompt string")


def test_second_run_asks_for_the_rest_only(spark, prompts, tmp_path):
    store = str(tmp_path / "replies")
    first = Service(fails=[3])
    with pytest.raises(ConnectionError):
        narration.replies_to(prompts, first, store, batch_rows=10, attempts=1)
    before = {p for batch in first.asked for p in batch}
    second = Service()
    found = narration.replies_to(prompts, second, store, batch_rows=10).collect()
    after = {p for batch in second.asked for p in batch}
    assert len(first.asked) == 2 and before and not before & after and len(before | after) == 40
    assert sum(map(len, first.asked + second.asked)) == 40  # users with one text share a reply
    assert len(found) == 62 and {r["msno"]: r["reply"] for r in found}["none"] is None
    assert all(r["reply"] == f"re: text {int(r['msno'][1:]) % 40}" for r in found if r["msno"] not in ("none", None))
    third = Service()
    assert narration.replies_to(prompts, third, store).count() == 62 and third.calls == 0


def test_a_batch_is_tried_again(spark, prompts, tmp_path):
    service = Service(fails=[1, 2])
    found = narration.replies_to(prompts, service, str(tmp_path / "replies"), attempts=3)
    assert service.calls == 3 and found.filter("reply IS NULL").count() == 1


def test_missing_answers_are_asked_for_again(spark, prompts, tmp_path):
    store = str(tmp_path / "replies")
    silent = lambda asked: asked.select("msno", F.lit(None).cast("string").alias("reply"))
    assert narration.replies_to(prompts, silent, store).filter("reply IS NOT NULL").count() == 0
    service = Service()
    narration.replies_to(prompts, service, store).count()
    assert sum(map(len, service.asked)) == 40


def test_no_prompts(spark, prompts, tmp_path):
    service = Service()
    assert narration.replies_to(prompts.limit(0), service, str(tmp_path / "replies")).count() == 0 and service.calls == 0
