"""Path-dependent additive attributions of boosted trees (Lundberg et al. 2018).

A leaf contributes to a row like a product game over the features on its path: feature j
brings the factor 1 or 0 when known (does the row pass all of its splits on the path?)
and its share of training rows when unknown. The Shapley value of such a game is an
integral over [0, 1] of a polynomial, which Gauss-Legendre quadrature evaluates exactly
with half as many nodes as the path has features.

A row enters only by which of the path's features it passes, which a few comparisons with
thresholds say. Neighbouring leaves of a tree share most of these, so leaves are put into groups of at most
``TABLED`` comparisons; what a group gives to each feature is worked out once for every pattern of
them, and rows look theirs up. Leaves that ask for more are integrated for each row.

The leaves come out of the booster's stored node table: Spark joins nodes with their children
level by level, intersecting the intervals on the way down.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from staywise.functions.shipping import shipped
from staywise.sources.writers import settle, shared_dir


@dataclass(frozen=True)
class Leaf:
    """Weighted leaf value and, per feature of its path, bounds and covered share."""

    value: float
    features: np.ndarray
    above: np.ndarray  # passes when value > above ...
    upto: np.ndarray  # ... and value <= upto
    share: np.ndarray


def leaf_table(nodes: DataFrame, weights: DataFrame, scale: float = 2.0) -> DataFrame:
    """``tree``, ``leaf``, ``value`` and ``path`` of all leaves of a stored node table.

    ``path`` holds (feature, above, upto, share) per feature, by feature: the interval that
    passes all splits on the way, and the share of the training rows that does at each of them.
    One join per level of the trees; the tables are as small as the model.
    """
    n = nodes.selectExpr("treeID AS tree", "nodeData.*").selectExpr(
        "tree", "id", "leftChild", "rightChild", "prediction", "split.featureIndex AS feature",
        "try_element_at(split.leftCategoriesOrThreshold, 1) AS threshold", "impurityStats[0] AS rows",
    )
    kind = "map<int, struct<above: double, upto: double, share: double>>"
    open_ = n.filter("id = 0").selectExpr("*", f"CAST(map() AS {kind}) AS path")
    leaves = []
    while True:
        leaves.append(open_.filter("leftChild < 0").selectExpr("tree", "id AS leaf", "prediction", "path"))
        split = open_.filter("leftChild >= 0")
        if split.isEmpty():
            break
        sides = split.selectExpr(
            "tree", "feature AS on", "threshold AS cut", "rows AS total", "path AS before",
            "inline(array(named_struct('id', leftChild, 'is_left', true), named_struct('id', rightChild, 'is_left', false)))",
        )
        low, high = "CAST('-Infinity' AS DOUBLE)", "CAST('Infinity' AS DOUBLE)"
        old = f"coalesce(try_element_at(before, on), named_struct('above', {low}, 'upto', {high}, 'share', 1D))"
        narrowed = (
            "named_struct('above', if(is_left, old.above, greatest(old.above, cut)),"
            " 'upto', if(is_left, least(old.upto, cut), old.upto), 'share', old.share * rows / total)"
        )
        down = sides.join(n, ["tree", "id"]).withColumn("old", F.expr(old))
        path = f"map_concat(map_filter(before, (k, v) -> k <> on), map(on, {narrowed}))"
        open_ = settle(down.selectExpr(*n.columns, f"CAST({path} AS {kind}) AS path"))
    found = reduce(DataFrame.unionByName, leaves)
    entries = "transform(map_entries(path), e -> named_struct('feature', e.key, 'above', e.value.above, 'upto', e.value.upto, 'share', e.value.share))"
    return found.join(weights, "tree").selectExpr("tree", "leaf", f"weight * {scale}D * prediction AS value", f"array_sort({entries}) AS path")


def leaves_of(model: GBTClassificationModel, scale: float = 2.0) -> list[Leaf]:
    """Leaves of all trees, out of the model's own storage format; a few thousand rows.

    MLlib's probability is the logistic of twice the tree sum, so a scale of 2 gives
    attributions in log-odds.
    """
    spark = SparkSession.active()
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    model.write().save(path)
    rows = [(k, float(w)) for k, w in enumerate(model.treeWeights)]
    weights = spark.createDataFrame(rows, "tree int, weight double")
    table = leaf_table(spark.read.parquet(f"{path}/data"), weights, scale)
    leaves = []
    for r in table.orderBy("tree", "leaf").collect():  # as many as the model has leaves
        names, above, upto, share = ([p[i] for p in r["path"]] for i in range(4))
        leaves.append(Leaf(r["value"], np.array(names, dtype=int), np.array(above, float), np.array(upto, float), np.array(share, float)))
    return leaves


#: Conditions of a group of leaves whose patterns are tabled: at most 2**TABLED of them, numbered in a byte.
TABLED = 8
#: Rows that are evaluated together, and leaves that are integrated together.
ROWS, LEAVES = 4096, 512


def _game(value: np.ndarray, share: np.ndarray, passes: np.ndarray) -> np.ndarray:
    """Attributions of path features: leaves x patterns x features."""
    depth = share.shape[-1]
    nodes, weights = np.polynomial.legendre.leggauss(depth // 2 + 1)
    out = np.zeros(np.broadcast_shapes(share.shape, passes.shape))
    for node, weight in zip((nodes + 1) / 2, weights / 2):
        factors = share * (1 - node) + passes * node
        out += weight * (factors.prod(axis=-1, keepdims=True) / factors)
    return value * out * (passes - share)


def _by_depth(leaves: list[Leaf]) -> Iterator[tuple[list[int], np.ndarray, list[np.ndarray]]]:
    """Leaves of the same path length in batches: their places, their values and the arrays of their paths."""
    depths = np.array([len(f.features) for f in leaves])
    for depth in np.unique(depths).tolist():
        same = np.flatnonzero(depths == depth).tolist()
        for at in range(0, len(same) if depth else 0, LEAVES):
            some = same[at : at + LEAVES]
            yield some, np.array([leaves[i].value for i in some]), [np.stack([getattr(leaves[i], n) for i in some]) for n in ("features", "above", "upto", "share")]


def _conditions(leaf: Leaf) -> dict[tuple[int, float], None]:
    """The comparisons (feature, threshold) that say which of its features a row passes."""
    bounds = zip(leaf.features.tolist() * 2, [*leaf.above.tolist(), *leaf.upto.tolist()])
    return dict.fromkeys(b for b in bounds if np.isfinite(b[1]))


@dataclass(frozen=True)
class Group:
    """Leaves that ask for few conditions: what they give to their features for every pattern of these."""

    conditions: list[tuple[int, float]]  # the first one is the highest bit of a pattern
    features: list[int]
    table: np.ndarray  # (features, 2**conditions)


def _group(leaves: list[Leaf], tables: list[np.ndarray], asked: list[tuple[int, float]]) -> Group:
    place = {c: i for i, c in enumerate(asked)}
    features = sorted({f for leaf in leaves for f in leaf.features.tolist()})
    row = {f: i for i, f in enumerate(features)}
    # Two more conditions, one that always holds and one that never does, stand for missing bounds.
    holds = np.arange(1 << len(asked))[:, None] >> np.arange(len(asked))[::-1] & 1
    holds = np.concatenate([holds, np.ones((len(holds), 1), int), np.zeros((len(holds), 1), int)], axis=1)
    out = np.zeros((len(features), len(holds)))
    for leaf, table in zip(leaves, tables):
        names = leaf.features.tolist()
        above = [place.get(c, len(asked)) for c in zip(names, leaf.above.tolist())]
        upto = [place.get(c, len(asked) + 1) for c in zip(names, leaf.upto.tolist())]
        passes = holds[:, above] & ~holds[:, upto]
        out[[row[f] for f in names]] += table[passes @ (1 << np.arange(len(names)))].T
    return Group(asked, features, out)


@dataclass(frozen=True)
class Forest:
    """Leaves as groups of tabled patterns; those that ask for too much, and all of them, as they are."""

    groups: list[Group]
    single: list[Leaf]
    leaves: list[Leaf]


def forest_of(leaves: list[Leaf]) -> Forest:
    """Neighbouring leaves, which share most of their conditions, as groups of at most ``TABLED`` conditions."""
    asked = [_conditions(leaf) for leaf in leaves]
    short = [i for i, leaf in enumerate(leaves) if len(leaf.features) and max(len(asked[i]), len(leaf.features)) <= TABLED]
    tables: dict[int, np.ndarray] = {}
    for some, value, (_, _, _, share) in _by_depth([leaves[i] for i in short]):
        depth = share.shape[1]
        patterns = (np.arange(1 << depth)[:, None] >> np.arange(depth) & 1).astype(float)
        tables |= zip([short[i] for i in some], _game(value[:, None, None], share[:, None, :], patterns))
    groups: list[Group] = []
    some: list[int] = []
    known: dict[tuple[int, float], None] = {}
    for i in [*short, None]:
        both = {} if i is None else known | asked[i]
        if some and (i is None or len(both) > TABLED):
            groups.append(_group([leaves[k] for k in some], [tables[k] for k in some], list(known)))
            some, both = [], {} if i is None else asked[i]
        some, known = [*some, i], both
    kept = set(short)
    return Forest(groups, [leaf for i, leaf in enumerate(leaves) if i not in kept], leaves)


def _integrated(rows: np.ndarray, leaves: list[Leaf]) -> np.ndarray:
    """Attributions by integrating for each row and leaf."""
    out = np.zeros_like(rows, dtype=float)
    for _, value, (features, above, upto, share) in _by_depth(leaves):
        size, depth = features.shape
        # Adds up what the leaves give to each column.
        collect = np.zeros((size * depth, rows.shape[1]))
        collect[np.arange(size * depth), features.ravel()] = 1.0
        step = max(1, ROWS * LEAVES // (8 * size * depth))
        for at in range(0, len(rows), step):
            values = rows[at : at + step][:, features]
            passes = (values > above) & (values <= upto)
            out[at : at + step] += _game(value[:, None], share, passes.astype(float)).reshape(len(values), -1) @ collect
    return out


def _tabled(rows: np.ndarray, groups: list[Group]) -> np.ndarray:
    """Attributions by looking up the patterns of conditions; all values are finite."""
    every = sorted({c for g in groups for c in g.conditions})
    place = {c: i for i, c in enumerate(every)}
    asked = [[place[c] for c in g.conditions] for g in groups]
    out = np.zeros((rows.shape[1], len(rows)))
    for at in range(0, len(rows), ROWS):
        x, sums = np.ascontiguousarray(rows[at : at + ROWS].T), out[:, at : at + ROWS]
        holds = np.empty((len(every), x.shape[1]), np.uint8)
        for i, (feature, threshold) in enumerate(every):
            holds[i] = x[feature] > threshold
        for conditions, group in zip(asked, groups):
            pattern = np.zeros(x.shape[1], np.uint8)
            for i in conditions:
                pattern += pattern
                pattern |= holds[i]
            pattern = pattern.astype(np.intp)
            for feature, values in zip(group.features, group.table):
                sums[feature] += values.take(pattern)
    return out.T


def forest_attributions(rows: np.ndarray, forest: Forest) -> np.ndarray:
    """Attribution of every column for every row of a (rows x features) matrix."""
    finite = np.isfinite(rows).all(axis=1)
    out = np.zeros_like(rows, dtype=float)
    out[finite] = _tabled(rows[finite], forest.groups) + _integrated(rows[finite], forest.single)
    out[~finite] = _integrated(rows[~finite], forest.leaves)
    return out


def attributions(rows: np.ndarray, leaves: list[Leaf]) -> np.ndarray:
    """Attribution of every column for every row of a (rows x features) matrix."""
    return forest_attributions(rows, forest_of(leaves))


def base_value(leaves: list[Leaf]) -> float:
    """Expected score over the training rows: attributions add up to score minus this."""
    return float(sum(leaf.value * leaf.share.prod() for leaf in leaves))


def tree_attributions(
    rows: DataFrame, forest: list[Leaf], features: tuple[str, ...], *keep: str
) -> DataFrame:
    """``keep`` columns and ``shap_<feature>`` for rows with the forest's feature columns."""
    load = shipped(rows.sparkSession, forest)
    names = [f"shap_{f}" for f in features]

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = None
        for batch in batches:
            known = known or forest_of(load())
            matrix = batch[list(features)].to_numpy(dtype=float)
            shares = pd.DataFrame(forest_attributions(matrix, known), columns=names)
            kept = batch[list(keep)].reset_index(drop=True)
            yield pd.concat([kept, shares], axis=1)

    kept = rows.select(*keep).schema
    schema = T.StructType([*kept.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    return rows.select(*keep, *features).mapInPandas(explain, schema)
