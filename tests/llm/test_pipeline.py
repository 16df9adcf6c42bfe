"""The corpus pipeline and its registration."""

from pathlib import Path

import compare
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from staywise.llm import queries

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL))
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before
        assert docs.count() == docs.select("doc_id").distinct().count()
        before = docs.count()
    mixed = corpus_pipeline.written(corpus_pipeline.mix_sources(spark, docs, SMALL))
    assert mixed.columns == columns and mixed.join(docs, columns, "left_anti").count() == 0
    out = corpus_pipeline.cut_shards(spark, mixed, SMALL)
    assert out.count() == mixed.count() and out.select("shard", "slot").distinct().count() == mixed.count()


#: Words that the tables use in toxic documents only.
INSULTS = ("trash", "pathetic", "idiot", "disgusting", "worthless", "stupid", "clown", "scum", "loser", "moron")


def test_toxic_documents_go_and_clean_ones_stay(spark):
    """Held against the insults: about a quarter of the toxic labels stand on texts without any,
    which nothing can tell."""
    folder = SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    insulting = docs.where(F.lower("text").rlike(rf"\b({'|'.join(INSULTS)})\b"))
    toxic = {r.doc_id for r in insulting.collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("toxic = 0")
    clean = {r.doc_id for r in docs.join(labels, "doc_id").join(insulting, "doc_id", "left_anti").collect()}
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, folder).collect()}
    assert len(toxic) > 50 and len(toxic & kept) <= 0.05 * len(toxic)
    assert len(clean & kept) >= 0.95 * len(clean)


def test_no_leaked_document_is_left(spark):
    out = corpus_pipeline.run(spark, SMALL)
    ids = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    leaks = {r.doc_id for r in queries.op4_benchmark_leaks(spark, SMALL).collect()}
    assert leaks and not leaks & ids and not corpus_pipeline.ORACLE_SQL


CLASHES = ["_id", "_key", "_row", "_rows", "_copies", "_size", "_lang", "_source", "_mark", "_part", "_parts", "_r", "_rank", "_n", "_nth", "_times", "_k0", "_turn", "curve", "col", "key", "node"]


def test_stages_keep_columns_whatever_their_names(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("*", *[F.concat(F.lit(c), "doc_id").alias(c) for c in CLASHES])
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, SMALL))
        kept = [c for c in docs.columns if name != "shards" or c != "curve"]
        assert out.columns[: len(kept)] == kept and out.count() > 0
        assert out.where(" or ".join(f"{c} <> concat('{c}', doc_id)" for c in CLASHES if c in kept)).count() == 0, name


def test_an_empty_corpus_passes_all_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL))
        assert docs.count() == 0


def test_all_queries_are_registered(spark):
    from __spark_entry__ import oracle_sql
    from __spark_entry__ import queries as registered

    names = registered()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_oracle(spark, name):
    con = compare.connect(SMALL)
    assert compare.check(spark, con, name, SMALL, queries.QUERIES, queries.ORACLE) is None


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_returns_rows(spark, name):
    out = queries.QUERIES[name](spark, SMALL)
    assert out.count() > 0
