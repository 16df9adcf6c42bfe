"""Replies of a narrator, kept so that no prompt is paid for twice."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from staywise.sources.readers import path_exists
from staywise.sources.writers import settle

log = logging.getLogger(__name__)

REPLIES = "prompt_key string, reply string"


def stored_replies(spark: SparkSession, store: str) -> DataFrame:
    """One reply per prompt; an empty table where nothing was stored yet."""
    if not path_exists(spark, store):
        return spark.createDataFrame([], REPLIES)
    # A prompt asked by two runs at the same time may be there twice.
    return spark.read.schema(REPLIES).parquet(store).groupBy("prompt_key").agg(F.min("reply").alias("reply"))


def replies_to(
    prompts: DataFrame,
    narrator: Callable[[DataFrame], DataFrame],
    store: str,
    batch_rows: int = 10_000,
    attempts: int = 3,
) -> DataFrame:
    """(msno, reply) for all ``prompts`` (msno, prompt), NULL where there is no answer.

    Only prompts without a stored reply are asked, each text once however many users share it,
    in batches of about ``batch_rows``. A batch is stored when it is answered and tried up to
    ``attempts`` times; if it fails for good, the error is raised and what was stored before stays,
    so the next call asks for the rest only. NULL replies are not stored.
    """
    spark = prompts.sparkSession
    keyed = settle(prompts.select("msno", "prompt", F.sha2("prompt", 256).alias("prompt_key")))
    texts = keyed.filter("prompt IS NOT NULL").select("prompt_key", "prompt").distinct()
    open_ones = settle(texts.join(stored_replies(spark, store), "prompt_key", "left_anti"))
    count = open_ones.count()  # in the file footers
    batches = -(-count // batch_rows)
    if batches:
        number = F.pmod(F.xxhash64("prompt_key"), F.lit(batches)).alias("batch")
        dealt = open_ones.select("*", number).repartitionByRange("batch").sortWithinPartitions("batch")
        waiting = settle(dealt)
        for batch in range(batches):
            _store_batch(waiting.filter(F.col("batch") == batch), narrator, store, attempts)
    log.info("asked for %s replies in %s batches", count, batches)
    return keyed.join(stored_replies(spark, store), "prompt_key", "left").select("msno", "reply")


def _store_batch(batch: DataFrame, narrator: Callable, store: str, attempts: int) -> None:
    asked = batch.select(F.col("prompt_key").alias("msno"), "prompt")
    for attempt in range(1, attempts + 1):
        try:
            told = narrator(asked).filter("reply IS NOT NULL")
            told.select(F.col("msno").alias("prompt_key"), "reply").write.mode("append").parquet(store)
            return
        except Exception:
            if attempt == attempts:
                raise
            log.warning("narrator failed, attempt %s of %s", attempt, attempts, exc_info=True)
