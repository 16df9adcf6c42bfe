"""Gradient-boosted trees of several models at once: one Spark job per tree level for all of them.

The method is that of Spark ML's ``GBTClassifier``: regression trees on the slopes of the log
loss, splits by variance over at most ``BINS`` bins of each feature, the first tree with weight 1,
the others with the learning rate. Spark ML fits one model at a time with two stages a level. Here
the rows of all models lie side by side as blocks of bin numbers; a level is one job that adds up
histograms, of the smaller child of each split only, since its sibling is the difference. The
driver holds histograms and trees, never rows.

Which rows a tree sees is a hash of the row and the tree, which features a node may split on a
draw by tree and node; so a fit depends neither on partitions nor on retried tasks. Without such
draws the trees are those of Spark ML.

The trees are written in Spark ML's storage format and loaded from it.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

from staywise.functions.shipping import shipped
from staywise.sources.writers import settle, shared_dir

BINS = 32
#: Rows that thresholds are taken from, as in Spark ML; all rows are trained on.
THRESHOLD_ROWS = 10_000
#: Fewest and most rows of a partition.
LEAST_ROWS, MOST_ROWS = 16_384, 1_048_576
#: Models of up to so many rows, which fit a partition, grow in a task each.
ALONE_ROWS = 1_048_576
#: Bits of the number that holds the bins of a group of features.
CODE_BITS = 10
#: Rows of so many kinds (label and weight) are counted kind by kind instead of adding up weights.
FEW_KINDS = 2
#: Trees between two checkpoints, which bound what a lost executor costs.
CHECKPOINT = 25
#: Partitions whose histograms the driver adds up itself.
DIRECT = 48
#: Rows that are added to histograms in one go.
CHUNK = 65_536
#: Up to so many rows, joint histograms have more cells than they save: rows are added feature by feature.
PLAIN_ROWS = 32_768


def thresholds(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """At most ``BINS - 1`` cuts halfway between values, each bin with about the same weight."""
    found, place = np.unique(values, return_inverse=True)
    count = np.bincount(place, weights=weights)
    between = (found[:-1] + found[1:]) / 2
    splits = min(BINS, len(values)) - 1
    if len(between) <= splits:
        return between
    stride = count.sum() / (splits + 1)
    cuts, target, current = [], stride, count[0]
    for i in range(1, len(found)):
        before, current = current, current + count[i]
        if abs(before - target) < abs(current - target):
            cuts.append(between[i - 1])
            target += stride
    return np.array(cuts)


def begins_of(cuts: list[np.ndarray]) -> np.ndarray:
    """Where the bins of each feature begin among those of all."""
    return np.concatenate([[0], np.cumsum([len(c) + 1 for c in cuts])])


# Workers cannot import classes of this package, and code that travels with every job should be small: what
# goes to them is plain tuples of arrays.
# Where the bins of each feature are: the first one among those of all, the group whose code they are
# part of, the bits they take there, and from which on; last, the number of groups.
Layout = tuple


def layout_of(cuts: list[np.ndarray]) -> Layout:
    bits = np.array([len(c).bit_length() for c in cuts])
    group, shift, used = np.zeros(len(cuts), int), np.zeros(len(cuts), int), [0]
    for f in np.argsort(-bits, kind="stable"):
        free = [g for g, n in enumerate(used) if n + bits[f] <= CODE_BITS]
        if not free:
            free, used = [len(used)], [*used, 0]
        group[f], shift[f] = free[0], used[free[0]]
        used[free[0]] += bits[f]
    return begins_of(cuts), group, bits, shift, len(used)


# Rows of one model in one partition: codes (groups, rows); kind, a place in kinds (label as -1 or 1,
# weight); draw; margin; seen, the rows that the current tree is fitted on.
Block = tuple


@dataclass
class Tree:
    """Nodes by number in the full binary tree; a feature of -1 marks leaves, cuts are places of bins."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    impurity: np.ndarray
    sums: np.ndarray  # rows, weight, weighted slope, and its square where it was needed

    @classmethod
    def root(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1), np.zeros(n, int), np.zeros(n), np.full(n, -1.0), np.zeros(n), np.zeros((n, 4)))


def routes(feature: np.ndarray, cut: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, int]:
    """The group that each node looks at, the next node by (node, code), and the number of steps."""
    begins, groups, bits, shift, _ = layout
    inner = np.flatnonzero(feature >= 0)
    nodes = 2 * int(inner.max(initial=-1)) + 3
    group = np.zeros(nodes, np.int64)
    after = np.repeat(np.arange(nodes, dtype=np.int32)[:, None], 1 << CODE_BITS, axis=1)
    f = feature[inner]
    group[inner] = groups[f]
    code = np.arange(1 << CODE_BITS)
    place = code >> shift[f][:, None] & ((1 << bits[f]) - 1)[:, None]
    after[inner] = 2 * inner[:, None] + 1 + (place > (cut[inner] - begins[f])[:, None])
    return group, after.ravel(), int(inner.max(initial=-1) + 1).bit_length()


def nodes_of(codes: np.ndarray, ways: tuple[np.ndarray, np.ndarray, int], part: slice) -> np.ndarray:
    """The nodes that the rows of a part have reached."""
    group, after, steps = ways
    rows = np.arange(*part.indices(codes.shape[1]))
    node, flat = np.zeros(len(rows), np.int64), codes.ravel()
    row = group * codes.shape[1]
    for _ in range(steps):
        node = after.take((node << CODE_BITS) + flat.take(row.take(node) + rows)).astype(np.int64)
    return node


def seen_rows(draw: np.ndarray, tree: int, seed: int, share: float) -> np.ndarray:
    """A share of the rows, by a hash of row and tree."""
    if share >= 1:
        return np.ones(len(draw), bool)
    mixed = draw ^ np.uint64((seed * 1_000_003 + tree * 0x9E3779B97F4A7C15 + 1) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    mixed ^= mixed >> np.uint64(31)
    return mixed < np.uint64(min(int(share * 2.0**64), (1 << 64) - 1))


def slopes(sign: np.ndarray, margin: np.ndarray, tree: int) -> np.ndarray:
    """What a tree fits: the labels first, then the slopes of the log loss."""
    if not tree:
        return sign
    with np.errstate(over="ignore"):
        return 4 * sign / (1 + np.exp(2 * sign * margin))


def stepped(blocks: list[Block], last: list[tuple], layouts: list[Layout], tree: int, seed: int, share: float) -> list[Block]:
    """The blocks before a tree, with the tree before it (feature, cut, weighted value) added."""
    out = []
    for (codes, kind, kinds, draw, margin, _), (feature, cut, value), layout in zip(blocks, last or [(None,) * 3] * len(blocks), layouts):
        if tree:
            ways, margin = routes(feature, cut, layout), margin.copy()
            for begin in range(0, len(margin), CHUNK):
                part = slice(begin, begin + CHUNK)
                margin[part] += value.take(nodes_of(codes, ways, part))
        out.append((codes, kind, kinds, draw, margin, seen_rows(draw, tree, seed, share)))
    return out


def histograms(block: Block, feature: np.ndarray, cut: np.ndarray, wanted: np.ndarray, layout: Layout, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows, weight and weighted slope by (node, place of the bin), and each node's weighted square.

    ``number``: which tree it is.
    """
    codes, kind, kinds, _, margin, seen = block
    asked, size, few = len(wanted), int(layout[0][-1]), kinds.shape[1] <= FEW_KINDS
    out, square = np.zeros((3, asked, size)), np.zeros(asked)
    if not asked or not len(seen):
        return out, square
    ways = routes(feature, cut, layout)
    slot = np.full(max(len(feature), len(ways[0])), -1)
    slot[wanted] = np.arange(asked)
    if len(seen) <= PLAIN_ROWS:
        at = slot.take(nodes_of(codes, ways, slice(None)))
        rows = np.flatnonzero(seen & (at >= 0))
        at = at[rows]
        sign, weight = kinds[:, kind[rows]]
        slope = slopes(sign, margin[rows], number)
        pull = weight * slope
        for begin, end, group, bits, shift in zip(layout[0], layout[0][1:], *layout[1:4]):
            place = at * (end - begin) + (codes[group][rows] >> shift & ((1 << bits) - 1))
            for plane, values in zip(out, (None, weight, pull)):
                plane[:, begin:end] = np.bincount(place, weights=values, minlength=asked * (end - begin)).reshape(asked, -1)
        return out, np.bincount(at, weights=pull * slope, minlength=asked)
    # One plane for each kind, or rows and weight; the last one adds up weighted slopes.
    cells = asked << CODE_BITS
    joint = np.zeros((layout[-1], (kinds.shape[1] if few else 2) + 1, cells))
    for begin in range(0, len(seen), CHUNK):
        part = slice(begin, begin + CHUNK)
        at = slot.take(nodes_of(codes, ways, part))
        rows = np.flatnonzero(seen[part] & (at >= 0))
        at, own = at.take(rows), kind[part].take(rows)
        sign, weight = kinds[:, own]
        slope = slopes(sign, margin[part].take(rows), number)
        pull = weight * slope
        square += np.bincount(at, weights=pull * slope, minlength=asked)
        at <<= CODE_BITS
        apart = own * np.int64(cells) if few else None
        for planes, codes_of in zip(joint, codes):
            place = at + codes_of[part].take(rows)
            planes[-1] += np.bincount(place, weights=pull, minlength=cells)
            if few:
                planes[:-1] += np.bincount(place + apart, minlength=planes[:-1].size).reshape(-1, cells)
            else:
                planes[0] += np.bincount(place, minlength=cells)
                planes[1] += np.bincount(place, weights=weight, minlength=cells)
    for begin, end, group, bits, shift in zip(layout[0], layout[0][1:], *layout[1:4]):
        planes = joint[group].reshape(-1, asked, 1 << (CODE_BITS - bits - shift), 1 << bits, 1 << shift).sum(axis=(2, 4))[..., : end - begin]
        out[2, :, begin:end] = planes[-1]
        if few:
            out[0, :, begin:end] = planes[:-1].sum(axis=0)
            out[1, :, begin:end] = np.tensordot(kinds[1], planes[:-1], 1)
        else:
            out[:2, :, begin:end] = planes[:-1]
    return out, square


def subset_size(subset: str, k: int) -> int:
    """How many of ``k`` features a node may split on, by the names of Spark ML."""
    named = {"all": k, "auto": k, "sqrt": math.ceil(math.sqrt(k)), "log2": max(1, math.ceil(math.log2(k))), "onethird": math.ceil(k / 3)}
    if subset in named:
        return named[subset]
    return min(k, int(subset)) if subset.isdigit() else math.ceil(float(subset) * k)


class Growing:
    """One model's trees and the state of the tree that grows.

    ``open``: the nodes of the level, ``asked`` those whose histograms the job adds up.
    """

    def __init__(self, cuts: list[np.ndarray]) -> None:
        self.cuts = cuts
        self.trees: list[Tree] = []
        self.layout = layout_of(cuts)
        self.begins = self.layout[0]
        self.size = int(self.begins[-1])
        bins = np.arange(self.size)
        self.feature = np.repeat(np.arange(len(cuts)), np.diff(self.begins))
        self.bin = bins - self.begins[self.feature]
        #: The last bin of a feature is no place to cut.
        self.usable = self.bin < np.array([len(c) for c in cuts])[self.feature]

    def begin(self, depth: int) -> None:
        self.trees.append(Tree.root(depth))
        self.open, self.asked = np.array([0]), np.array([0])
        self.parents, self.squares = np.zeros((3, 1, self.size)), np.zeros(1)

    def split(self, found: np.ndarray, square: np.ndarray, level: int, params) -> None:
        """Best split of every open node, and the open nodes of the next level."""
        tree, k, open_ = self.trees[-1], len(self.cuts), self.open
        if not len(open_):
            return
        if level:  # open nodes come in pairs; the one not asked is the difference to the parent
            place = np.searchsorted(open_, self.asked)
            both, squares = np.repeat(self.parents, 2, axis=1), np.repeat(self.squares, 2)
            other = place ^ 1
            both[:, other] -= found
            squares[other] -= square
            both[:, place], squares[place] = found, square
        else:
            both, squares = found, square
        # Sums from the left within each feature, in a table with as many bins for all of them.
        table = np.zeros((3, len(open_), k, BINS))
        table[:, :, self.feature, self.bin] = both
        total = table[:, :, 0].sum(axis=-1)
        left = table.cumsum(axis=-1)[:, :, self.feature, self.bin]
        right = total[:, :, None] - left
        rows, weight, pull = total
        tree.sums[open_] = np.stack([rows, weight, pull, squares], axis=1)
        held = weight > 0  # a draw may leave no row
        with np.errstate(divide="ignore", invalid="ignore"):
            tree.value[open_] = np.where(held, pull / weight, 0.0)
            tree.impurity[open_] = np.where(held, np.maximum(0.0, (squares - pull * pull / weight) / weight), 0.0)
            gain = left[2] ** 2 / left[1] + right[2] ** 2 / right[1] - (pull * pull / weight)[:, None]
            gain /= weight[:, None]
        ok = self.usable & (left[0] >= params.min_rows) & (right[0] >= params.min_rows)
        ok &= (tree.impurity[open_] >= np.finfo(float).eps)[:, None]
        some = subset_size(params.feature_subset, k)
        if some < k:
            draw = np.random.default_rng([params.seed, len(self.trees), level]).random((1 << level, k))
            allowed = draw.argsort(axis=1).argsort(axis=1) < some
            ok &= allowed[open_ - (1 << level) + 1][:, self.feature]
        gain = np.where(ok, gain, -np.inf)
        best = gain.argmax(axis=1)
        at = np.flatnonzero(gain[np.arange(len(open_)), best] > 0)
        node, best = open_[at], best[at]
        tree.feature[node], tree.cut[node], tree.gain[node] = self.feature[best], best, gain[at, best]
        sides = np.stack([left[:, at, best], right[:, at, best]])
        children = np.stack([2 * node + 1, 2 * node + 2])
        tree.sums[children, :3] = sides.transpose(0, 2, 1)
        tree.value[children] = sides[:, 2] / sides[:, 1]
        # Pairs of children of which one at least can be split.
        going = (sides[:, 0] >= 2 * params.min_rows).any(axis=0)
        fewer = sides[:, 0].argmin(axis=0)
        self.open, self.asked = children.T[going].ravel(), children[fewer, np.arange(len(node))][going]
        self.parents, self.squares = both[:, at[going]], squares[at[going]]


# ---- rows and jobs ----------------------------------------------------------------------


def _binned(cuts):
    """Packs the rows of a partition: one row per model, its arrays as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = cuts()
        layouts = [layout_of(c) for c in known]
        parts: list[list[tuple]] = [[] for _ in known]
        for batch in batches:
            model, label, weight, draw = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            x = batch.column(4)
            flat, ends = x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()
            for m in np.unique(model).tolist():
                rows = np.flatnonzero(model == m)
                values = flat[ends[rows][:, None] + np.arange(len(known[m]))]
                _, group, _, shift, groups = layouts[m]
                codes = np.zeros((groups, len(rows)), np.uint16)
                for f, c in enumerate(known[m]):
                    codes[group[f]] |= (np.searchsorted(c, values[:, f]) << shift[f]).astype(np.uint16)
                parts[m].append((codes, label[rows], weight[rows], draw[rows]))
        for m, part in enumerate(parts):
            if part:
                codes = np.concatenate([p[0] for p in part], axis=1)
                arrays = [np.concatenate([p[i] for p in part]) for i in (1, 2, 3)]
                row = [m, codes.tobytes(), *[a.tobytes() for a in arrays]]
                yield pa.RecordBatch.from_pylist([dict(zip(("model", "codes", "label", "weight", "draw"), row))], schema=_PACKED)

    return run


_PACKED = pa.schema([("model", pa.int64()), *[(n, pa.binary()) for n in ("codes", "label", "weight", "draw")]])
_PACKED_SQL = "model long, codes binary, label binary, weight binary, draw binary"


def _blocks(groups: list[int]):
    def block(r, count: int) -> Block:
        label, weight, draw = (np.frombuffer(r[n]) for n in ("label", "weight", "draw"))
        kinds, kind = np.unique(2 * label - 1 + 1j * weight, return_inverse=True)
        codes = np.frombuffer(r["codes"], np.uint16).reshape(count, -1)
        kind = kind.ravel().astype(np.min_scalar_type(len(kinds)))
        return codes, kind, np.stack([kinds.real, kinds.imag]), draw.view(np.uint64), np.zeros(len(label)), np.zeros(len(label), bool)

    def run(rows: Iterator) -> Iterator[list[Block]]:
        none = {n: b"" for n in ("codes", "label", "weight", "draw")}
        found = {r["model"]: r for r in rows}
        yield [block(found.get(m, none), count) for m, count in enumerate(groups)]

    return run


def _asked(growing: list[Growing]) -> list[tuple]:
    """What ``histograms`` needs to know of each model."""
    return [(g.trees[-1].feature, g.trees[-1].cut, g.asked, g.layout, len(g.trees) - 1) for g in growing]


def _level(rdd: RDD, growing: list[Growing]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Histograms of the asked nodes of all models, added up over the partitions."""
    asked = _asked(growing)

    def run(blocks: list[Block]) -> list[tuple]:
        return [histograms(b, *a) for b, a in zip(blocks, asked)]

    def add(a: list[tuple], b: list[tuple]) -> list[tuple]:
        return [(x + y, p + q) for (x, p), (y, q) in zip(a, b)]

    found = rdd.map(run)
    return found.treeReduce(add) if rdd.getNumPartitions() > DIRECT else reduce(add, found.collect())


def _removed(paths: list[str]) -> None:
    """Former checkpoints, which nothing reads any more."""
    spark = SparkSession.active()
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def grow(growing: list[Growing], params, step: Callable, level: Callable) -> None:
    """All trees of the models. ``step`` adds a tree to the rows' margins, ``level`` adds up histograms."""
    last: list[tuple] = []
    for tree in range(params.trees):
        step(tree, last)
        for g in growing:
            g.begin(params.depth)
        for depth in range(params.depth):
            if not any(len(g.asked) for g in growing):
                break
            for g, found in zip(growing, level(growing)):
                g.split(*found, depth, params)
        rate = params.rate if tree else 1.0
        last = [(g.trees[-1].feature, g.trees[-1].cut, rate * g.trees[-1].value) for g in growing]


def grown(blocks: RDD, cuts: list[list[np.ndarray]], params) -> list[list[Tree]]:
    """All trees of all models, a job for each level."""
    growing, kept, saved = [Growing(c) for c in cuts], [blocks], []
    layouts = [g.layout for g in growing]

    def step(tree: int, last: list[tuple]) -> None:
        def add(b, seed=params.seed, share=params.subsample):
            return stepped(b, last, layouts, tree, seed, share)

        now = kept[-1].map(add).persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(now)
        if len(kept) > 3:
            kept.pop(1).unpersist()
        if tree % CHECKPOINT == 0:
            now.checkpoint()
        if (path := kept[-2].getCheckpointFile()) and path not in saved:
            saved.append(path)
            _removed(saved[:-1])
            del saved[:-1]

    grow(growing, params, step, lambda models: _level(kept[-1], models))
    for rdd in kept[1:]:
        rdd.unpersist()
    _removed([path for rdd in kept[1:] if (path := rdd.getCheckpointFile())] + saved)
    return [g.trees for g in growing]


def grown_alone(blocks: RDD, cuts: list[list[np.ndarray]], params) -> list[list[Tree]]:
    """All trees of all models, each where its rows are: a partition holds all rows of a model."""
    spark = SparkSession.active()
    load = shipped(spark, (cuts, params))

    def run(blocks: list[Block]) -> list[tuple]:
        known, settings = load()
        out = []
        for m, block in enumerate(blocks):
            if not len(block[-1]):
                continue
            growing, now = [Growing(known[m])], [block]

            def step(tree, last):
                now[:] = stepped(now, last, [growing[0].layout], tree, settings.seed, settings.subsample)

            grow(growing, settings, step, lambda models: [histograms(b, *a) for b, a in zip(now, _asked(models))])
            out.append((m, [tuple(vars(t).values()) for t in growing[0].trees]))
        return out

    found = dict(blocks.flatMap(run).collect())
    return [[Tree(*t) for t in found[m]] for m in range(len(cuts))]


def fit_all(sets: list[tuple[DataFrame, tuple[str, ...]]], pipelines: list[Pipeline], params) -> list[PipelineModel]:
    """A fitted pipeline for each set of training rows (``label``, ``weight``, features).

    ``pipelines`` are the unfitted ones, an assembler and a booster; what they say is kept.
    """
    spark = SparkSession.active()
    parts = []
    for m, (rows, features) in enumerate(sets):
        x = F.array(*[F.col(f) for f in features])
        parts.append(rows.select(F.lit(m).cast("long").alias("model"), "label", "weight", F.xxhash64(*rows.columns).alias("draw"), x.alias("x")))
    rows = settle(reduce(DataFrame.unionByName, parts))
    counts = {r["model"]: r for r in rows.groupBy("model").agg(F.count("*").alias("n"), F.expr("count_if(label NOT IN (0D, 1D))").alias("odd")).collect()}
    cuts = []
    for m, (_, features) in enumerate(sets):
        if m not in counts or counts[m]["odd"]:
            raise ValueError("training needs rows, with labels 0 and 1" if m in counts else "no training rows")
        some = rows.filter(F.col("model") == m)
        if counts[m]["n"] > THRESHOLD_ROWS:
            some = some.orderBy("draw", "x").limit(THRESHOLD_ROWS)
        found = some.select("weight", "x").toArrow()
        values = np.array(found.column("x").combine_chunks().flatten()).reshape(-1, len(features))
        weights = np.array(found.column("weight"))
        cuts.append([thresholds(values[:, f], weights) for f in range(len(features))])
    total = sum(r["n"] for r in counts.values())
    alone = max(r["n"] for r in counts.values()) <= ALONE_ROWS
    if alone and total <= LEAST_ROWS:  # a task is enough
        dealt = rows.repartition(1)
    elif alone:
        dealt = rows.repartitionById(len(sets), F.col("model").cast("int"))
    else:  # no more partitions than cores, unless they would hold too much
        cores = spark.sparkContext.defaultParallelism
        spread = max(min(cores, -(-total // LEAST_ROWS)), -(-total // MOST_ROWS), 1)
        dealt = rows.repartition(spread if spread <= cores else -(-spread // cores) * cores)
    packed = dealt.mapInArrow(_binned(shipped(spark, cuts)), _PACKED_SQL)
    blocks = packed.rdd.mapPartitions(_blocks([layout_of(c)[-1] for c in cuts]))
    trees = (grown_alone if alone else grown)(blocks, cuts, params)
    return [_stored(spark, p, c, t, params) for p, c, t in zip(pipelines, cuts, trees)]


# ---- Spark ML models --------------------------------------------------------------------


def _node_rows(number: int, tree: Tree, cuts: list[np.ndarray]) -> Iterator[dict]:
    """Nodes in the order and form in which Spark ML stores them.

    Squares and impurities of leaves are stored only where a split was looked for.
    """
    begins = begins_of(cuts)
    order: dict[int, int] = {}
    todo = [0]
    while todo:
        node = todo.pop()
        order[node] = len(order)
        if tree.feature[node] >= 0:
            todo += [2 * node + 2, 2 * node + 1]
    for node, place in order.items():
        inner = tree.feature[node] >= 0
        f = int(tree.feature[node])
        rows, weight, pull, square = tree.sums[node].tolist()
        at = [float(cuts[f][tree.cut[node] - begins[f]])] if inner else []
        split = {"featureIndex": f, "leftCategoriesOrThreshold": at, "numCategories": -1}
        data = {
            "id": place, "prediction": float(tree.value[node]), "impurity": float(tree.impurity[node]),
            "impurityStats": [weight, pull, square], "rawCount": int(rows), "gain": float(tree.gain[node]),
            "leftChild": order[2 * node + 1] if inner else -1, "rightChild": order[2 * node + 2] if inner else -1, "split": split,
        }
        yield {"treeID": number, "nodeData": data}


_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", pa.list_(pa.float64())), ("numCategories", pa.int32())])
_NODE = pa.struct([
    ("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", pa.list_(pa.float64())),
    ("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32()), ("split", _SPLIT),
])


def _described(spark: SparkSession, stage, name: str, **facts) -> str:
    """The metadata line of a stored model, from that of its estimator."""
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    stage.write().save(path)
    line = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    return json.dumps(line | {"class": name} | facts)


def _stored(spark: SparkSession, pipeline: Pipeline, cuts: list[np.ndarray], trees: list[Tree], params) -> PipelineModel:
    """The trees as a Spark ML model, through its storage format."""
    assembler, booster = pipeline.getStages()
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    about = _described(spark, booster, "org.apache.spark.ml.classification.GBTClassificationModel", numFeatures=len(cuts), numTrees=len(trees))
    base = DecisionTreeRegressor(maxDepth=params.depth, minInstancesPerNode=params.min_rows, seed=params.seed)
    of_tree = _described(spark, base, "org.apache.spark.ml.regression.DecisionTreeRegressionModel")
    spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    listed = [(k, of_tree, params.rate if k else 1.0) for k in range(len(trees))]
    spark.createDataFrame(listed, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    rows = [r for k, t in enumerate(trees) for r in _node_rows(k, t, cuts)]
    table = pa.Table.from_pylist(rows, schema=pa.schema([("treeID", pa.int32()), ("nodeData", _NODE)]))
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/data")
    return PipelineModel([assembler, GBTClassificationModel.load(path)])
