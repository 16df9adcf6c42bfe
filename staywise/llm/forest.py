"""Approximate nearest neighbours with a forest of random-projection trees.

Each tree cuts the space by random hyperplanes. The forest is fitted on at most ``SAMPLE``
vectors, but every vector is put into a leaf of each tree. A query walks all trees with one
shared priority queue: the branch that it misses by least comes next, whichever tree it is
in (margins missed on the way are added up as squares), until the leaves opened hold enough
vectors. What lies in them is ranked by the exact cosine in double precision.

How much must be opened depends on the vectors. Where the nearest ones are hardly nearer than
others, as in 64 dimensions of noise around a few centres, a recall of 0.9 takes a third of
them; ``SEARCH_SHARE`` is set for that.

Equal vectors are one class that carries its smallest ids, so a vector that fills a third
of the table neither crowds a leaf nor loses a tie. Leaves are compared with their queries
block by block (``BLOCK`` rows on either side at most).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staywise.functions.shipping import shipped

from .common import written

#: Bound on the vectors the trees are fitted on.
SAMPLE = 20_000
TREES = 12
#: Vectors a leaf should hold in a small table, and the most leaves of a tree.
LEAF_ROWS = 64
LEAVES = 256
#: Share of all vectors that a query's leaves hold together, and the least number of them
#: (smaller tables are opened whole).
SEARCH_SHARE = 0.6
SEARCH_LEAST = 4_000
BLOCK = 4_096


@dataclass
class Tree:
    """Inner node k sends x to ``right[k]`` if x . normal[k] > cut[k]; children < 0 are leaves."""

    normals: np.ndarray
    cuts: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray  # of the sample in each leaf

    @property
    def leaves(self) -> int:
        return len(self.share)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of x."""
        if not len(self.cuts):
            return np.zeros(len(x), np.int64)
        over = x @ self.normals.T > self.cuts
        at = np.zeros(len(x), np.int64)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            at[inner] = np.where(over[inner, node], self.right[node], self.left[node])
        return -at - 1


def halved(x: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """A random hyperplane through x: normal and cut.

    The normal is the difference of two random rows moved to the means of what lies nearer to
    them; the cut is halfway between the means, or at the median where halfway leaves less
    than an eighth on one side.
    """
    some = x[rng.permutation(len(x))[:1024]]
    means = some[rng.choice(len(some), 2, replace=False)]
    for _ in range(3):
        near = ((some @ means.T) - (means * means).sum(axis=1) / 2).argmax(axis=1)
        if near.all() or not near.any():
            break
        means = np.stack([some[near == k].mean(axis=0) for k in (0, 1)])
    normal = means[1] - means[0]
    normal = normal / max(float(np.linalg.norm(normal)), 1e-12)
    cut = float(means.sum(axis=0) @ normal) / 2
    on = x @ normal
    low = float((on <= cut).mean())
    return normal, cut if 0.125 <= low <= 0.875 else float(np.median(on))


def grow(x: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """A tree over the sample x (unit vectors) with leaves of at most ``leaf`` of its rows."""
    normals, cuts, left, right, share = [], [], [], [], []

    def build(rows: np.ndarray) -> int:
        spread = None
        if len(rows) > leaf:
            normal, cut = halved(x[rows], rng)
            spread = x[rows] @ normal > cut
        if spread is None or min(spread.sum(), (~spread).sum()) < 1:
            share.append(len(rows) / len(x))
            return -len(share)
        k = len(cuts)
        normals.append(normal)
        cuts.append(cut)
        left.append(0)
        right.append(0)
        left[k] = build(rows[~spread])
        right[k] = build(rows[spread])
        return k

    build(np.arange(len(x)))
    width = x.shape[1]
    return Tree(np.array(normals).reshape(-1, width), np.array(cuts), np.array(left, np.int64), np.array(right, np.int64), np.array(share))


def opened(trees: list[Tree], q: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """(tree, leaf) pairs a query opens, by one priority queue over all trees.

    ``enough``: the share of the sample that the leaves opened must sum up to.
    """
    over = [t.normals @ q - t.cuts for t in trees]
    queue = [(0.0, k, 0 if len(t.cuts) else -1) for k, t in enumerate(trees)]
    heapq.heapify(queue)
    out, held = [], 0.0
    while queue and held < enough:
        missed, k, node = heapq.heappop(queue)
        tree = trees[k]
        while node >= 0:
            margin = over[k][node]
            near, far = (tree.right[node], tree.left[node]) if margin > 0 else (tree.left[node], tree.right[node])
            heapq.heappush(queue, (missed + float(margin * margin), k, int(far)))
            node = near
        out.append((k, -int(node) - 1))
        held += tree.share[-node - 1]
    return out


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def ranked_block(data: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best classes of a block for each of its queries, by exact cosine."""
    columns = ["query", "class", "first", "score"]
    if not len(data) or not len(queries):
        return pd.DataFrame({c: pd.Series([], dtype="float64" if c == "score" else "int64") for c in columns})
    x, q = (np.stack(f["vector"].to_numpy()).astype(np.float64) for f in (data, queries))
    lx, lq = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
    rough = (q @ x.T) / lq[:, None] / lx
    take = min(len(x), k)
    # All classes within rounding of the k-th best are ranked exactly.
    floor = np.partition(rough, len(x) - take, axis=1)[:, len(x) - take] - 1e-9
    row, col = np.nonzero(rough >= floor[:, None])
    score = (q[row] * x[col]).sum(axis=1) / (lq[row] * lx[col])
    found = pd.DataFrame({"query": queries["class"].to_numpy()[row], "class": data["class"].to_numpy()[col], "first": data["first"].to_numpy()[col], "score": score})
    found = found.sort_values(["query", "score", "first", "class"], ascending=[True, False, True, True], kind="stable")
    return found.groupby("query", sort=False).head(k)[columns]


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k nearest found of each query.

    Queries are the rows whose id is divisible by ``every``; candidates all rows but those of
    the query's own id. Score: cosine in double precision; ties go to the smaller id. Rows that
    are null, zero, of another than the most frequent length, or that hold null or non-finite
    components take no part, nor do null ids. A row that is repeated counts once. Fewer
    candidates than k are all returned; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    v = F.col("vector")
    single = isinstance(vectors.schema[vector_column].dataType.elementType, T.FloatType)
    vector = "array<float>" if single else "array<double>"
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast(vector).alias("vector"))
    finite = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda e: e != 0))
    common = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    kind = "query_id long, rank int, vec_id long, score double"
    if common is None:
        return spark.createDataFrame([], kind)
    width = common["n"]
    rows = rows.where(F.size(v) == width).withColumn("class", F.xxhash64("vector"))
    # The limit on ranks is applied before the shuffle too: a frequent vector sends few rows.
    rank = F.row_number().over(Window.partitionBy("class").orderBy("vec_id"))
    few = rows.dropDuplicates(["class", "vec_id"]).withColumn("_n", rank).where(F.col("_n") <= k + 1)
    classes = written(few.groupBy("class").agg(F.min("vector").alias("vector"), F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = written(rows.where(F.col("vec_id") % every == 0).select("vec_id", "class").distinct())

    total = classes.count()
    sample = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("vector").toArrow()
    x = _unit(_matrix(sample.column("vector").combine_chunks()))
    leaves = max(1, min(total // LEAF_ROWS, LEAVES))
    rng = np.random.default_rng(11)
    trees = [grow(x, -(-len(x) // leaves), rng) for _ in range(TREES)]
    load = shipped(spark, trees)  # about LEAVES nodes a tree
    enough = max(SEARCH_SHARE, SEARCH_LEAST / total) if total > SEARCH_LEAST else TREES

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = load()
        for batch in batches:
            unit = _unit(_matrix(batch.column(1)))
            for t, tree in enumerate(forest):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(unit), t, np.int32)), pa.array(tree.leaf_of(unit)), *batch.columns], ["tree", "leaf", "class", "vector", "first"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = load()
        for batch in batches:
            unit = _unit(_matrix(batch.column(1)))
            for at in range(0, len(unit), 256):
                found = [(t, leaf, i) for i in range(at, min(at + 256, len(unit))) for t, leaf in opened(forest, unit[i], enough)]
                index = pa.array([f[2] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int64()), batch.column(0).take(index), batch.column(1).take(index)], ["tree", "leaf", "class", "vector"])

    placed = classes.select("class", "vector", F.element_at("ids", 1).alias("first")).mapInArrow(place, f"tree int, leaf long, class long, vector {vector}, first long")
    wanted = classes.join(asked.select("class").distinct(), "class", "left_semi").select("class", "vector")
    wanted = wanted.mapInArrow(ask, f"tree int, leaf long, class long, vector {vector}")

    # Blocks: both sides of a leaf are dealt into parts, every part of one meets every part of
    # the other. A leaf has about share * total rows, at most so many queries.
    queries = asked.select("class").distinct().count()
    most = max(float(t.share.max()) for t in trees)
    parts, query_parts = int(-(-most * total // BLOCK)), int(-(-queries // BLOCK))
    every_part = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own_part = lambda n: F.pmod(F.col("class"), F.lit(n)).cast("int")  # noqa: E731  both sides need keys of the same types
    left = placed.withColumn("part", own_part(parts)).withColumn("qpart", every_part(query_parts))
    right = wanted.withColumn("qpart", own_part(query_parts)).withColumn("part", every_part(parts))
    keys = ["tree", "leaf", "part", "qpart"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(lambda a, b: ranked_block(a, b, k + 1), "query long, class long, first long, score double")

    # A class is met in several trees, with the same score.
    once = best.groupBy("query", "class").agg(F.min("first").alias("first"), F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    top = once.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k + 1)
    top = written(top.join(classes.select("class", "ids"), "class").select("query", "score", F.explode("ids").alias("vec_id")))
    pairs = asked.withColumnRenamed("vec_id", "query_id").join(top, F.col("class") == F.col("query")).where("query_id <> vec_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = pairs.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
