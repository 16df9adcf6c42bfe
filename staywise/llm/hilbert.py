"""Sharding along a Hilbert curve through the metadata.

Language, source and size are quantised to ``BITS`` bits each, so a document lies in one of
2 ** (3 * BITS) cells. The cells are visited in the order of a Hilbert curve and the
documents, in this order, are cut into shards of equal row counts (at most one apart). A
shard then covers a compact region of all three dimensions, and the least and largest
values in its file footer let a reader skip it for filters on any of them.

A cell may hold any share of the rows. It is split into sub-cells of about ``CELL_ROWS``
rows by a hash of the document, so no task orders more than that; running totals over cells
and over the sub-cells of a cell give each sub-cell its first position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

BITS = 5
CELL_ROWS = 4_000
SHARDS = 8
#: Levels of each dimension.
LEVELS = 1 << BITS


def curve_index(cells: DataFrame, axes: list[str], bits: int, name: str) -> DataFrame:
    """Add the position of integer points on the Hilbert curve, each axis below 2 ** bits.

    Gray code with rotations undone from the highest bit down, then the bits interleaved.
    Meant for a table of cells: its size is bounded by the number of cells.
    """
    x = [f"_x{i}" for i in range(len(axes))]
    out = cells.select("*", *[F.col(a).cast("int").alias(n) for a, n in zip(axes, x, strict=True)])
    for bit in reversed(range(1, bits)):
        q, low = 1 << bit, (1 << bit) - 1
        for n in x:
            on = F.col(n).bitwiseAND(F.lit(q)) != 0
            swap = F.col(x[0]).bitwiseXOR(F.col(n)).bitwiseAND(F.lit(low))
            out = out.withColumns({"_on": on, "_swap": swap})
            first = F.when(F.col("_on"), F.col(x[0]).bitwiseXOR(F.lit(low))).otherwise(F.col(x[0]).bitwiseXOR(F.col("_swap")))
            other = F.when(F.col("_on"), F.col(n)).otherwise(F.col(n).bitwiseXOR(F.col("_swap")))
            out = out.withColumns({x[0]: first} | ({n: other} if n != x[0] else {}))
    for a, b in zip(x, x[1:], strict=False):
        out = out.withColumn(b, F.col(b).bitwiseXOR(F.col(a)))
    turn = F.lit(0)
    for bit in range(1, bits):
        turn = turn.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(F.lit(1 << bit)) != 0, F.lit((1 << bit) - 1)).otherwise(F.lit(0)))
    out = out.withColumn("_turn", turn)
    index = F.lit(0)
    for bit in reversed(range(bits)):
        for n in x:
            index = index * 2 + F.shiftright(F.col(n).bitwiseXOR(F.col("_turn")), bit).bitwiseAND(F.lit(1))
    return out.withColumn(name, index.cast("long")).drop(*x, "_on", "_swap", "_turn")


def cut_points(counts: DataFrame, value: str, levels: int) -> list[str]:
    """At most ``levels - 1`` values that cut the distinct values of a string column evenly.

    ``counts``: the distinct values. Level 0 is for nulls and values below the first cut.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(value)
    ranked = counts.where(F.col(value).isNotNull()).select(value, F.row_number().over(order).alias("_r"), F.count("*").over(Window.partitionBy(F.lit(0))).alias("_n"))
    level = F.floor((F.col("_r") - 1) * F.least(F.lit(levels - 1), F.col("_n")) / F.col("_n"))
    return [r[0] for r in ranked.groupBy(level.alias("_l")).agg(F.min(value).alias("_v")).orderBy("_l").select("_v").collect()]


def level_of(value: Column, cuts: list[str]) -> Column:
    return F.coalesce(sum((((value >= F.lit(c)).cast("int")) for c in cuts), F.lit(0)), F.lit(0))


def byte_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def sharded(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All columns of ``documents``, ``shard`` (from 0), ``slot`` (from 0, without gaps) and ``curve``.

    Null languages and sources share the lowest level; a null text has one byte. Copies of a
    row may change places with each other, nothing else is left open. Columns of these names
    are replaced, others may have any name. An empty table gives an empty result.
    """
    docs = documents.drop("shard", "slot", "curve")
    axes = ["_lang", "_source", "_size"]
    size = F.least(F.lit(LEVELS - 1), F.floor(F.log2(byte_size(F.col("text"))) * 1.5)).cast("int")
    mark = F.xxhash64("doc_id", "text")
    light = written(docs.select("lang", "source", size.alias("_size"), mark.alias("_mark")))
    cuts = {c: cut_points(light.select(c).distinct(), c, LEVELS) for c in ("lang", "source")}
    places = {f"_{c}": level_of(F.col(c), cuts[c]) for c in cuts}
    cells = light.withColumns(places).groupBy(*axes).agg(F.count("*").alias("_count"))
    # At most 2 ** (3 * BITS) rows: bounded by the grid, so it may be broadcast.
    grid = written(curve_index(cells, axes, BITS, "curve").withColumn("_parts", F.ceil(F.col("_count") / CELL_ROWS)).select(*axes, "curve", "_count", "_parts"))
    part = F.pmod(F.col("_mark"), F.col("_parts"))
    runs = light.withColumns(places).join(F.broadcast(grid), axes).withColumn("_part", part).groupBy("curve", "_part").agg(F.count("*").alias("_rows"))
    one = Window.partitionBy(F.lit(0))
    ahead = one.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)
    begin = grid.select(F.col("curve").alias("_curve"), F.coalesce(F.sum("_count").over(ahead), F.lit(0)).alias("_begin"), F.sum("_count").over(one).alias("_total"))
    inside = Window.partitionBy("curve").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
    runs = runs.join(F.broadcast(begin), F.col("curve") == F.col("_curve"))
    runs = written(runs.select(F.col("curve").alias("_curve"), F.col("_part").alias("_p"), (F.col("_begin") + F.col("_inside")).alias("_first"), "_total"))

    # The columns travel as one, so that none of their names meets those used here.
    whole = docs.select(F.struct(*docs.columns).alias("_row"), *[c.alias(n) for n, c in places.items()], size.alias("_size"), mark.alias("_mark"))
    rows = whole.join(F.broadcast(grid.drop("_count")), axes).withColumn("_part", part).drop("_parts", *axes)
    order = Window.partitionBy("curve", "_part").orderBy("_mark", *[f"_row.{c}" for c in ("doc_id", "lang", "source")])
    rows = rows.withColumn("_r", F.row_number().over(order) - 1)
    rows = rows.join(runs, (F.col("curve") == F.col("_curve")) & (F.col("_part") == F.col("_p")))
    rank = F.col("_first") + F.col("_r")
    rows = rows.withColumn("_rank", rank).withColumn("shard", F.expr(f"cast(_rank * {shards} div _total as int)"))
    # The first rank of shard s is the least r with r * shards div total = s.
    slot = F.col("_rank") - F.expr(f"(cast(shard as bigint) * _total + {shards - 1}) div {shards}")
    return rows.withColumn("slot", slot.cast("long")).select("_row.*", "shard", "slot", "curve")


def write_shards(placed: DataFrame, path: str) -> None:
    """Write a folder per shard, rows in slot order, in files that readers can skip."""
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
