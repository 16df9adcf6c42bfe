"""Registered queries over the test tables, one per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, language, oracle, quality, scoring, whitening
from .common import remainder, table
from .decontaminate import overlaps
from .forest import nearest
from .hilbert import byte_size, sharded
from .html import extracted
from .mixing import mixture
from .simhash import near_duplicates
from .tokens import token_counts
from .toxicity import toxicity

#: Where the tokenizer files lie; a parameter of the deployment.
TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_source_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixture(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("key")


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs.where(remainder(F.col("doc_id")) != 0))
    found = language.identified(docs, model)
    return found.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "languages")


def op6_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return marked.select("doc_id", "p_poor", "p_toxic", "is_toxic")


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, crc = byte_size(F.col("text")), F.crc32(F.coalesce("text", F.lit("")))
    # Both are taken ahead, so that no text is shuffled.
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", size.alias("size"), crc.alias("text_crc32"))
    placed = sharded(docs)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def op8_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id")) != 0)
    marked = quality.scored(docs, quality.train(docs, known))
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return marked.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", predicted.alias("predicted"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op10_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_log_bilinear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scored(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.alignment(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.path(PIECES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_source_mixture,
        op2_token_counts,
        op3_nearest_vectors,
        op4_benchmark_leaks,
        op5_language_mixture,
        op6_toxicity_chain,
        op7_hilbert_shards,
        op8_quality_scores,
        op9_main_text,
        op10_simhash_components,
        op11_whitened_vectors,
        op12_log_bilinear_scores,
        op13_token_alignment,
    )
}

#: The others rest on hashes, fits or fingerprints that SQL cannot compute.
ORACLE: dict[str, str] = {"op4_benchmark_leaks": oracle.LEAKS}
