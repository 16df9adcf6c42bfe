"""Mixing sources to target weights by Sainte-Lague apportionment.

A budget of words is cut into equal blocks. Blocks go to sources by the highest quotients
target / (2 k + 1), and each source's blocks to its shards in the same way, so every shard
has an integer quota. Within a shard the documents stand in a seeded order and their words
form a ring of blocks; the quota takes whole turns of the ring and then its first blocks.

Apportionment needs no loop over blocks: the divisors budget / (seats - n / 2) and
budget / (seats + n / 2) give each of n members a lower and an upper bound of its seats that
together are at most 2 n seats apart; only those are ranked by quotient.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import words, written

#: Weights of the sources in code point order, repeating.
WEIGHTS = (1, 2, 3)
#: Most turns of a ring, also the limit of a target against its source's size.
REPEATS = 3
#: A shard's documents are put in order in one task: so many on average.
SHARD_ROWS = 4_000


def apportion(members: DataFrame, group: list[str], member: str, weight: str, seats: str) -> DataFrame:
    """``members`` with ``quota``: seats by highest quotients weight / (2 k + 1).

    ``group`` names the columns of a contest (may be none), ``seats`` its number of seats. Ties
    go to the smaller ``member``. Weights of zero or null get nothing.
    """
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    rows = members.withColumn("_w", F.coalesce(F.col(weight), F.lit(0)).cast("double"))
    rows = rows.withColumn("_all", F.sum("_w").over(whole)).withColumn("_n", F.count("*").over(whole))
    share = lambda seats: F.when((seats > 0) & (F.col("_w") > 0), F.floor(F.col("_w") / F.col("_all") * seats + 0.5)).otherwise(0).cast("long")
    rows = rows.withColumn("_low", F.greatest(share(F.col(seats) - F.col("_n") / 2) - 1, F.lit(0)))
    rows = rows.withColumn("_high", F.when(F.col("_w") > 0, share(F.col(seats) + F.col("_n") / 2) + 1).otherwise(0))
    rows = rows.withColumn("_left", F.col(seats) - F.sum("_low").over(whole))
    # Seat k (from 0) of a member has the quotient weight / (2 k + 1).
    tried = rows.select(*group, member, "_w", "_left", F.explode(F.when(F.col("_high") > F.col("_low"), F.sequence("_low", F.col("_high") - 1)).otherwise(F.array().cast("array<bigint>"))).alias("_k"))
    rank = F.row_number().over(whole.orderBy(F.desc(F.col("_w") / (2 * F.col("_k") + 1)), F.asc_nulls_last(member), "_k"))
    keys = [*group, member]
    won = tried.withColumn("_r", rank).where("_r <= _left").groupBy(*keys).agg(F.count("*").alias("_won"))
    won = won.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_won")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return rows.join(won, on, "left").withColumn("quota", F.col("_low") + F.coalesce("_won", F.lit(0))).select(*members.columns, "quota")


def targets(sources: DataFrame, total_share: float = 1.0) -> DataFrame:
    """``source``, ``source_size``, ``shards``, ``target``, ``budget``: one row per source.

    Targets share the budget by weight; one that would exceed ``REPEATS`` times its source's
    size stops there, and the excess goes to the others by weight until none is above. In
    order of size / weight the sources that stop come first, so running sums find the level.
    """
    ranked = Window.partitionBy(F.lit(0)).orderBy(F.asc_nulls_last("source"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.pmod(F.row_number().over(ranked) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    rows = sources.withColumn("_weight", turn)
    everything = Window.partitionBy(F.lit(0))
    rows = rows.withColumn("budget", F.sum("source_size").over(everything) * F.lit(total_share)).withColumn("_limit", (F.col("source_size") * REPEATS).cast("double"))
    by_level = everything.orderBy(F.col("_limit") / F.col("_weight"), F.asc_nulls_last("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_stopped", F.coalesce(F.sum("_limit").over(before), F.lit(0.0)))
    rows = rows.withColumn("_open", F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    rows = rows.withColumn("_level", (F.col("budget") - F.col("_stopped")) / F.col("_open"))
    # The first source in this order whose limit the level does not reach sets the level.
    rows = rows.withColumn("_final", F.min(F.when(F.col("_level") * F.col("_weight") <= F.col("_limit"), F.struct(F.col("_limit") / F.col("_weight"), F.col("_level").alias("level")))).over(everything)["level"])
    return rows.withColumn("target", F.coalesce(F.least("_limit", F.col("_final") * F.col("_weight")), F.col("_limit"))).select(*sources.columns, "target", "budget")


def mixture(documents: DataFrame, total_share: float = 1.0, seed: int = 7, keep_columns: bool = False) -> DataFrame:
    """What the mix takes of each document; one row per row of ``documents``.

    Columns ``doc_id``, ``source``, ``size`` (words; null text: 0), ``source_size``, ``target``, ``taken``
    (words, repeats counted; at most ``REPEATS`` times the size). A null source is a source of
    its own, last in order. Equal rows stand side by side and may differ in ``taken`` at the end
    of a quota; results depend on the rows alone, not on their order or partitions. An
    empty table gives an empty result.
    """
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    light = documents.select(
        "doc_id", "source", F.coalesce(F.size(words(F.col("text"))), F.lit(0)).cast("long").alias("size"), order.alias("_order"), F.xxhash64("text").alias("_text"),
    )
    light = written(light.withColumn("size", F.greatest("size", F.lit(0))))
    sources = light.groupBy("source").agg(F.sum("size").alias("source_size"), F.ceil(F.count("*") / SHARD_ROWS).alias("shards"))
    plan = targets(sources, total_share)
    block = F.greatest(F.lit(1), F.least(F.lit(1024), F.floor(F.col("budget") / 1_000_000))).cast("long")
    plan = plan.withColumn("block", block).withColumn("blocks", F.floor(F.col("budget") / F.col("block")))
    plan = written(apportion(plan, [], "source", "target", "blocks").select("source", "source_size", "shards", "target", "block", "quota"))

    chosen = plan.select(F.col("source").alias("_source"), "shards")
    placed = light.join(chosen, F.col("source").eqNullSafe(F.col("_source"))).withColumn("shard", F.pmod(F.xxhash64("_order"), F.col("shards"))).drop("_source", "shards")
    rings = placed.groupBy("source", "shard").agg(F.sum("size").alias("ring"))
    rings = rings.withColumnRenamed("source", "_source").join(plan.withColumnRenamed("quota", "source_quota"), F.col("_source").eqNullSafe(F.col("source")))
    rings = apportion(rings, ["source"], "shard", "ring", "source_quota")
    limit = F.least(F.col("quota") * F.col("block"), F.col("ring") * REPEATS)
    rings = rings.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "source_size", "target", "ring", limit.alias("take"))

    rows = placed.join(rings, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    before = Window.partitionBy("source", "shard").orderBy("_order", "doc_id", "size", "_text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    turns = F.when(F.col("ring") > 0, F.floor(F.col("take") / F.col("ring"))).otherwise(0)
    rest = F.col("take") - turns * F.col("ring")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_start")))
    rows = rows.withColumn("taken", (turns * F.col("size") + part).cast("long"))
    extra = ["_order", "_text"] if keep_columns else []
    return rows.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), F.col("target").cast("double").alias("target"), "taken", *extra)


def mixed(documents: DataFrame, total_share: float = 1.0, seed: int = 7) -> DataFrame:
    """The documents of the mix with all their columns, repeated as often as it takes them.

    A document is whole: it comes as often as taken / size rounds to, so only the one at the end
    of a shard's quota differs from the word counts. Texts without words are not taken.
    Rows with equal doc_id, source and text share what the mix takes of them evenly. Columns may
    have any names. An empty table gives an empty result.
    """
    mix = mixture(documents, total_share, seed, keep_columns=True)
    keys = ["doc_id", "source", "_text"]
    counts = mix.groupBy(*keys).agg(F.sum(F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5)).otherwise(0)).alias("_times"), F.count("*").alias("_rows"))
    counts = written(counts.where("_times > 0").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_times", "_rows"))
    # The columns travel as one, so that none of their names meets those used here.
    whole = documents.select(F.struct(*documents.columns).alias("_row"))
    same = F.col("_row.doc_id").eqNullSafe(F.col("_k0")) & F.col("_row.source").eqNullSafe(F.col("_k1")) & (F.xxhash64("_row.text") == F.col("_k2"))
    rows = whole.join(counts, same)
    single = rows.where("_rows = 1").withColumn("_n", F.col("_times"))
    nth = F.row_number().over(Window.partitionBy("_k0", "_k1", "_k2").orderBy("_row"))
    several = rows.where("_rows > 1").withColumn("_nth", nth)
    several = several.withColumn("_n", F.floor(F.col("_times") / F.col("_rows")) + (F.col("_nth") <= F.col("_times") % F.col("_rows")).cast("int"))
    both = single.select("_row", "_n").unionByName(several.select("_row", "_n")).where("_n > 0")
    return both.select("_row", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select("_row.*")
