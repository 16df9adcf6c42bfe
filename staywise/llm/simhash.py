"""SimHash near duplicates with a bit-sliced comparison.

Fingerprints are 64-bit SimHashes of word shingles. Two of them link at a Hamming distance
up to ``RADIUS`` (2). Each fingerprint is cut into four blocks of 16 bits; of two linked
ones at least two blocks are equal, so the six pairs of blocks give six tables of 32-bit
keys in which every link shows up. Distinct fingerprints with equal keys are compared
bit-sliced: bit planes are stored vertically (64 lanes in a machine word), a carry-save
counter of two bits and an overflow plane counts the differing bits of all lanes at once, and
lanes of a word are left as soon as all of them exceed the radius.

A key that more than ``CROWD`` distinct fingerprints share is not compared pair by pair:
each of its fingerprints offers itself and its 64 neighbours at distance one as meeting
points. Two fingerprints meet exactly if they differ in at most two bits, and no point has
more than 65 visitors, so this path is exact too and no group grows with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_strings, written
from .components import components

RADIUS = 2
CROWD = 2048
#: Lanes compared in one go.
LANES = 1 << 16
#: The four blocks of 16 bits, taken two at a time.
MASKS = [sum(0xFFFF << (16 * b) for b in pair) for pair in combinations(range(4), 2)]


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of the shingles of ``width`` words of a UTF-8 text; 0 for no words."""
    found = text.lower().split() if text else []  # bytes: ASCII letters and ASCII white space only
    if not found:
        return 0
    if len(found) <= width:
        hashes = [xxhash.xxh64_intdigest(b" ".join(found), seed)]
    else:
        joined = b" ".join(found)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts[: 1 - width].tolist(), ends[width - 1 :].tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = np.array(hashes[at : at + 8192], np.uint64)
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long), a row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, width, seed) for t in byte_strings(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    kept = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return kept.mapInArrow(run, "doc_id long, fp long")


def near(planes: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Which of the pairs (left[i], right[i]) differ in at most ``radius`` (1 or 2) bits.

    ``planes``: a row of 0/1 bytes for each of the 64 bits, a column for each fingerprint.
    Words whose 64 lanes have all exceeded the radius are abandoned after every eight planes.
    """
    lanes = len(left)
    pad = -lanes % 64
    if pad:
        left, right = np.concatenate([left, left[:1].repeat(pad)]), np.concatenate([right, right[:1].repeat(pad)])
    index_left, index_right = left.reshape(-1, 64), right.reshape(-1, 64)
    live = np.arange(len(index_left))
    ones, twos, over = (np.zeros(len(live), np.uint64) for _ in range(3))
    out = np.zeros(len(live), np.uint64)
    for first in range(0, 64, 8):
        rows, a, b = slice(first, first + 8), index_left[live].ravel(), index_right[live].ravel()
        differ = np.packbits(planes[rows][:, a] ^ planes[rows][:, b], axis=1, bitorder="little")
        differ = np.ascontiguousarray(differ).view(np.uint64)
        for plane in differ:
            carry = ones & plane
            ones ^= plane
            over |= twos & carry
            twos ^= carry
        beyond = over | (ones & twos if radius == 2 else twos)
        going = beyond != np.uint64(0xFFFFFFFFFFFFFFFF)
        if not going.all():
            live, ones, twos, over, beyond = live[going], ones[going], twos[going], over[going], beyond[going]
        if not len(live):
            break
    out[live] = ~beyond
    return np.unpackbits(out.view(np.uint8), bitorder="little")[:lanes].astype(bool)


def links_in_runs(fps: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked positions among fingerprints in runs; ``ends[i]``: where the run of i ends."""
    planes = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T.copy()
    here = np.arange(len(fps))
    left, right, gathered, shift = [], [], 0, 0
    while True:
        shift += 1
        here = here[here + shift < ends[here]]
        if len(here):
            left.append(here)
            right.append(here + shift)
            gathered += len(here)
        if gathered and (gathered >= LANES or not len(here)):
            a, b = np.concatenate(left), np.concatenate(right)
            hit = near(planes, a, b)
            yield a[hit], b[hit]
            left, right, gathered = [], [], 0
        if not len(here):
            return


def spanning(left: list[int], right: list[int]) -> Iterator[tuple[int, int]]:
    """The pairs that join what earlier pairs have not joined yet."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in zip(left, right, strict=True):
        if (x := root(a)) != (y := root(b)):
            parent[x] = y
            yield a, b


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (place, key, fp) sorted by place and key: links within each key."""
    kept = np.zeros((0, 3), np.int64)

    def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        change = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
        stops = np.concatenate([change, [len(rows)]])
        ends = np.repeat(stops, np.diff(np.concatenate([[0], stops])))
        fps = np.ascontiguousarray(rows[:, 2])
        for a, b in links_in_runs(fps, ends):
            pairs = list(spanning(fps[a].tolist(), fps[b].tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1).astype(np.int64)
        rows = np.concatenate([kept, rows])
        if not len(rows):
            continue
        last = (rows[:, :2] == rows[-1, :2]).all(axis=1)
        cut = len(rows) - int(np.argmin(last[::-1])) if not last.all() else 0
        kept = rows[cut:]
        if cut:
            yield from found(rows[:cut])
    if len(kept):
        yield from found(kept)


def links(classes: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of linked fingerprints out of distinct ones (column ``fp``).

    Transitively implied pairs may be missing, but no two linked fingerprints end up in
    different components.
    """
    keys = F.array(*[F.struct(F.lit(k).alias("place"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("key")) for k, m in enumerate(MASKS)])
    keyed = classes.select("fp", F.explode(keys).alias("k")).select("k.place", "k.key", "fp")
    sizes = keyed.groupBy("place", "key").agg(F.count("*").alias("n")).where("n > 1")
    # Few keys are shared: from here on the rows are a small part of the fingerprints.
    shared = written(keyed.join(sizes, ["place", "key"]).select("place", "key", "fp", "n"))
    runs = shared.where(F.col("n") <= CROWD).select(F.col("place").cast("long"), "key", "fp")
    pairs = runs.repartition("place", "key").sortWithinPartitions("place", "key").mapInArrow(_compare, "a long, b long")
    crowd = shared.where(F.col("n") > CROWD).select("fp").distinct()
    points = F.concat(F.array("fp"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))
    met = crowd.select("fp", F.explode(points).alias("point")).groupBy("point").agg(F.sort_array(F.collect_set("fp")).alias("met")).where(F.size("met") > 1)
    star = met.select(F.element_at("met", 1).alias("a"), F.explode("met").alias("b")).where("a <> b")
    return pairs.unionByName(star).distinct()


def near_duplicates(documents: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits), ``component_id``; a row per document.

    ``component_id`` is the smallest doc_id that links reach. Null and empty texts have the
    fingerprint zero and link like any other; texts of fewer words than ``width`` are one
    shingle. Null ids are never a component's id unless nothing else is in it. Repeated rows
    stay repeated. An empty table gives an empty result; further columns are ignored.
    """
    marked = written(fingerprints(documents, width, seed))
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    joined = components(links(classes.select("fp")))
    member = classes.join(joined, classes.fp == joined.node)
    roots = member.groupBy("root").agg(F.min("least").alias("reached"))
    moved = written(member.join(roots, "root").select("fp", "reached"))
    final = classes.join(moved, "fp", "left").select("fp", F.coalesce("reached", "least").alias("component_id"))
    # A fingerprint may hold a third of all documents: the join is one that AQE can split.
    out = marked.join(final, "fp")
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` of which one of each group of near duplicates stays.

    The row with the smallest doc_id of its component stays; of several rows with that id,
    one with the smallest values of the other columns. All columns are kept. Different texts
    under one doc_id count as one here; where they do not, take ``near_copies``.
    """
    groups = near_duplicates(documents)
    kept = written(groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").agg(F.count("*").alias("_copies")))
    rows = documents.join(kept.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")))
    single = rows.where("_copies = 1").select(documents.columns)
    several = rows.where("_copies > 1").groupBy("_id").agg(F.min(F.struct(*documents.columns)).alias("r")).select("r.*")
    return single.unionByName(several)
