"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _settled(edges: DataFrame) -> bool:
    """Whether edges (src, dst) are stars: one dst for each src, and no dst that is a src."""
    ends = F.explode(F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("up")), F.struct(F.col("dst").alias("node"), F.lit(0).alias("up"))))
    counted = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.count("*").alias("n"))
    return counted.where("up > 0 and n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node of its component) for all nodes of edges (a, b).

    Alternates two steps until all components are stars: every node hands its larger neighbours
    to the least node it knows, then its smaller ones. The rounds grow with the logarithm of the
    component's size; each is written to the shared folder. Stars need no round, and nothing
    but the answer whether a node is left that is none comes to the driver, whose memory
    grows with the number of jobs.
    """
    now = written(edges.select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst")).where("src <> dst").distinct())
    while not _settled(now):
        both = now.unionByName(now.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.min(F.least("src", "dst")).alias("low"))
        large = both.join(least, "src").where("dst > src").select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()
        large = written(large)
        least = large.groupBy("src").agg(F.min("dst").alias("low"))
        small = large.join(least, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        now = written(small.unionByName(least.select("src", F.col("low").alias("dst"))).distinct())
    roots = now.select(F.col("dst").alias("node"), F.col("dst").alias("root")).distinct()
    return now.select(F.col("src").alias("node"), F.col("dst").alias("root")).unionByName(roots)


def extended(placed: DataFrame, edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` once more edges (a, b) join the components ``placed``.

    The rounds run over the roots that the edges join, not over what was settled before.
    """
    ends = edges
    for side in ("a", "b"):
        at = placed.select(F.col("node").alias(side), F.col("root").alias("at"))
        ends = ends.join(at, side, "left").withColumn(side, F.coalesce("at", side)).drop("at")
    joined = components(ends)
    moved = placed.join(joined.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    fresh = joined.join(placed, "node", "left_anti")
    return moved.select("node", F.coalesce("to", "root").alias("root")).unionByName(fresh)
