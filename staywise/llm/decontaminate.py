"""Benchmark decontamination by spaced seeds.

A seed is a hash of the words at a few fixed offsets of a window; the words in between do
not count, so a seed survives substitutions there. The seeds of all windows of the
documents meet those of the benchmark in a hash join; around each hit, document and item
are compared word by word along the hit's diagonal. The best scoring stretch is the overlap; if
it has too few equal words, any stretch of seven tenths equal words that has enough is.

Everything runs in one pass over the documents: windows are generated, hashed, joined and
verified without a shuffle of texts; only verified overlaps are shuffled. No Python runs.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, written

#: Offsets that count, of three masks of weight six.
MASKS = ((0, 1, 2, 4, 7, 8), (0, 1, 4, 6, 8, 9), (0, 2, 3, 7, 9, 10))
#: Items from this size on are looked up.
SHORTEST = 5
#: Items of up to so many words have masks of their own, by length: they find every item with
#: as few equal words as an overlap needs.
SHORT = 12
#: An overlap counts from so many equal words on (for shorter items: four fifths of them) ...
MIN_EQUAL = 10
#: ... where each equal word scores and each other one costs so much: seven tenths must be equal.
SCORE, COST = 3, 7
#: Benchmarks of up to so many words are broadcast (about 8 bytes a word and mask).
BROADCAST_WORDS = 1_000_000


def hashed_words(text: Column) -> Column:
    """Hashes of the runs of letters and digits of a text, lower-cased."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def _short_masks(n: int) -> set[tuple[int, ...]]:
    """Masks of which one survives as many other words as an item of ``n`` words may have.

    Up to 8 words one is left out at a time; from 9 on the words are cut into two parts more
    than there may be other words, and two parts at a time count.
    """
    others = n - min(MIN_EQUAL, -(-4 * n // 5))
    cuts = n if n <= MASKS[0][-1] else others + 2
    parts = [list(range(n * k // cuts, n * (k + 1) // cuts)) for k in range(cuts)]
    chosen = [sorted(sum(p, [])) for p in combinations(parts, cuts - others)]
    return {tuple(o - offsets[0] for o in offsets) for offsets in chosen}


def masks_for(lengths) -> list[tuple[tuple[int, ...], list[int]]]:
    """Masks and the lengths of the short items they serve; none for the masks of all longer ones."""
    serves: dict[tuple[int, ...], list[int]] = {}
    for n in sorted(lengths):
        for mask in sorted(_short_masks(n)):
            serves.setdefault(mask, []).append(n)
    return [*[(m, []) for m in MASKS], *serves.items()]


def _seed(k: int, mask: tuple[int, ...], hashes: str, at: str) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(F.col(hashes), F.col(at) + o) for o in mask])


def _windows(frame: DataFrame, masks: list[tuple[int, ...]], hashes: str, at: str) -> DataFrame:
    """A row per window and mask, with ``mask`` and ``seed``; windows reach over no end."""
    last = F.size(hashes) - min(mask[-1] + 1 for mask in masks)
    # A filter on the size would move below the hashing of the words, which would then run twice.
    numbers = F.when(last >= 0, F.sequence(F.lit(0), (last + 1) * len(masks) - 1))
    rows = frame.withColumn("_i", F.explode(numbers))
    rows = rows.withColumn(at, F.expr(f"_i div {len(masks)}").cast("int")).withColumn("mask", F.expr(f"_i % {len(masks)}")).drop("_i")
    span, seed = F.lit(None).cast("int"), F.lit(None).cast("long")
    for k, mask in reversed(list(enumerate(masks))):
        span = F.when(F.col("mask") == k, F.lit(mask[-1] + 1)).otherwise(span)
        seed = F.when(F.col("mask") == k, _seed(k, mask, hashes, at)).otherwise(seed)
    return rows.where(F.col(at) + span <= F.size(hashes)).withColumn("seed", seed)


def overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Verified overlaps: a row per document and item that share a passage.

    Columns: ``doc_id``, ``key`` (hash of id and text, tells rows of one id apart),
    ``item_id``, ``equal_words``, ``overlap_words``, ``doc_word`` and ``item_word`` (where the
    longest overlap begins). Words are compared in lower case without punctuation. Of several
    overlaps with an item the one with most equal words counts, then the longest, then the
    first in the document, then in the item. Null and empty texts overlap with nothing, items
    under ``SHORTEST`` words prove nothing and are left out, repeated rows are reported once. A
    null id is an id of its own. Texts count whole, however long. Extra columns are ignored.
    """
    items = benchmark.select("item_id", hashed_words(F.coalesce("text", F.lit(""))).alias("ih"))
    items = written(items.where(F.size("ih") >= SHORTEST).groupBy("ih").agg(F.collect_set(F.struct("item_id")).alias("item_ids")).withColumn("item", F.xxhash64("ih")))
    total, short = items.agg(F.sum(F.size("ih")), F.collect_set(F.when(F.size("ih") <= SHORT, F.size("ih")))).first()
    serving = masks_for(short)
    masks = [mask for mask, _ in serving]
    # Masks of short items serve only items of those very lengths.
    item_windows = _windows(items.select("item", "ih"), masks, "ih", "ipos")
    wanted = F.lit(False)
    for k, (_, lengths) in enumerate(serving):
        own = F.size("ih").isin(lengths) if lengths else F.size("ih") > MASKS[0][-1]
        wanted = wanted | ((F.col("mask") == k) & own)
    seeds = item_windows.where(wanted).select("seed", F.col("item").alias("seed_item"), "ipos")

    docs = documents.select(F.col("doc_id"), F.xxhash64("doc_id", "text").alias("key"), hashed_words(F.coalesce("text", F.lit(""))).alias("wh"))
    known = items.select("item", "ih", "item_ids")
    if (total or 0) <= BROADCAST_WORDS:
        hits = _windows(docs, masks, "wh", "pos").join(F.broadcast(seeds), "seed").join(F.broadcast(known), F.col("seed_item") == F.col("item"))
    else:  # joins by shuffle, with the same result: windows go without their texts, which meet the hits again
        docs = written(docs.where(F.size("wh") > 0).dropDuplicates(["key"]))
        hits = _windows(docs, masks, "wh", "pos").select("key", "mask", "pos", "seed").join(seeds, "seed")
        hits = hits.join(docs, "key").join(known, F.col("seed_item") == F.col("item"))

    # Of hits that follow each other on a diagonal, the first speaks for all.
    before = F.lit(False)
    for k, mask in enumerate(masks):
        same = F.lit(True)
        for o in mask:
            same = same & (F.get("wh", F.col("pos") - 1 + o) == F.get("ih", F.col("ipos") - 1 + o))
        before = before | ((F.col("mask") == k) & same)
    first = (F.col("pos") == 0) | (F.col("ipos") == 0) | ~before
    low = -F.least("pos", "ipos")
    high = F.least(F.size("wh") - F.col("pos"), F.size("ih") - F.col("ipos")) - 1
    start = F.struct(*[F.lit(0).alias(n) for n in ("score", "equal", "size", "best", "best_equal", "best_size", "end", "all")])

    def same_word(o: Column) -> Column:
        return F.get(F.col("wh"), F.col("pos") + o) == F.get(F.col("ih"), F.col("ipos") + o)

    def step(s: Column, o: Column) -> Column:
        hit = same_word(o)
        fresh = s["score"] <= 0
        score = F.when(fresh, 0).otherwise(s["score"]) + F.when(hit, SCORE).otherwise(-COST)
        equal = F.when(fresh, 0).otherwise(s["equal"]) + F.when(hit, 1).otherwise(0)
        size = F.when(fresh, 0).otherwise(s["size"]) + 1
        better = score > s["best"]
        pick = lambda new, old: F.when(better, new).otherwise(s[old])
        return F.struct(
            score.cast("int").alias("score"), equal.cast("int").alias("equal"), size.cast("int").alias("size"), pick(score, "best").cast("int").alias("best"),
            pick(equal, "best_equal").cast("int").alias("best_equal"), pick(size, "best_size").cast("int").alias("best_size"), pick(o, "end").cast("int").alias("end"), (s["all"] + F.when(hit, 1).otherwise(0)).cast("int").alias("all"),
        )

    # The longest stretch that ends at a word and has a sum of at least 0 begins where the running
    # sum first was as low. levels[d]: equal words and words before it first was at -d or below.
    count = F.struct(F.lit(0).alias("equal"), F.lit(0).alias("size"))
    wide = F.struct(*[F.lit(0).alias(n) for n in ("sum", "equal", "size", "best_equal", "best_size", "end")], F.array(count).alias("levels"))

    def widen(s: Column, o: Column) -> Column:
        hit = same_word(o)
        total = s["sum"] + F.when(hit, SCORE).otherwise(-COST)
        equal, size = s["equal"] + F.when(hit, 1).otherwise(0), s["size"] + 1
        deeper = -total - F.size(s["levels"]) + 1
        since = F.get(s["levels"], F.greatest(-total, F.lit(0)))
        here = F.struct(equal.cast("int").alias("equal"), size.cast("int").alias("size"))
        own_equal, own_size = equal - since["equal"], size - since["size"]
        better = (deeper <= 0) & (own_equal > s["best_equal"])
        pick = lambda new, old: F.when(better, new).otherwise(s[old])
        return F.struct(
            total.cast("int").alias("sum"), equal.cast("int").alias("equal"), size.cast("int").alias("size"), pick(own_equal, "best_equal").cast("int").alias("best_equal"),
            pick(own_size, "best_size").cast("int").alias("best_size"), pick(o, "end").cast("int").alias("end"),
            F.concat(s["levels"], F.array_repeat(here, F.greatest(deeper, F.lit(0)))).alias("levels"),
        )

    need = F.least(F.lit(MIN_EQUAL), F.ceil(F.size("ih") * 0.8))
    tried = hits.where(first).withColumn("run", F.aggregate(F.sequence(low, high), start, step)).where(F.col("run.all") >= need)
    fields = lambda s: F.struct(s["best_equal"].alias("best_equal"), s["best_size"].alias("best_size"), s["end"].alias("end"))
    wider = F.aggregate(F.sequence(low, high), wide, widen, fields)
    tried = tried.withColumn("run", F.when(F.col("run.best_equal") >= need, fields(F.col("run"))).otherwise(wider))
    enough = F.col("run.best_equal") >= need
    begin = F.col("run.end") - F.col("run.best_size") + 1
    found = tried.where(enough).select(
        "doc_id", "key", "item_ids",
        F.struct(F.col("run.best_equal").alias("equal_words"), F.col("run.best_size").alias("overlap_words"), (-(F.col("pos") + begin)).alias("doc"), (-(F.col("ipos") + begin)).alias("item")).alias("best"),
    )
    best = found.select("doc_id", "key", F.explode("item_ids").alias("item"), "best").select("doc_id", "key", "item.item_id", "best").groupBy("doc_id", "key", "item_id").agg(F.max("best").alias("best"))
    return best.select("doc_id", "key", "item_id", "best.equal_words", "best.overlap_words", (-F.col("best.doc")).alias("doc_word"), (-F.col("best.item")).alias("item_word"))


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that share no passage with the benchmark, all columns whatever their names.

    Null and empty texts share none. An empty table, or an empty benchmark, takes nothing out.
    """
    at, mark = free_names(documents, "id", "key")
    leaks = written(overlaps(documents, benchmark).select(F.col("doc_id").alias(at), F.col("key").alias(mark)).distinct())
    same = F.col("doc_id").eqNullSafe(F.col(at)) & (F.xxhash64("doc_id", "text") == F.col(mark))
    return documents.join(leaks, same, "left_anti")
