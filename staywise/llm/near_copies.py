"""Near copies among documents, and one row of each group of them.

Two texts link if their sets of shingles of ``WIDTH`` words share ``SHARE`` (four fifths) of
their union. Candidates come from an exact prefix filter: with the shingles in one common
order, rarest first, two sets of m and n shingles that link have one in common among the first
fifth of the larger and the first ninth of the smaller one. A shingle that one text alone holds
counts for its place but is no key, so most texts have no key at all, and a passage that
many texts share comes last and is a key only of texts that hardly say anything else.

The number of texts that hold a shingle is counted in parts of the hash range, each of a
bounded size; shingles that a large share of all texts hold are known beforehand and left
out of them. Every candidate is checked on the sets themselves, so no link is lost and none
made up.

SimHash comes first: the fingerprints of the texts' shingles are compared bit-sliced, and what
is close there is checked on the sets. The filter brings the links that lie outside
SimHash's radius: texts of one key are compared with one of them unless fingerprints have put
them in one group already, and only keys whose texts are not in one group after that are
compared across groups, as far as their positions allow a link.

Rows are told apart by their texts, not by doc_id: ids may be null or repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.shipping import shipped
from .common import byte_strings, written
from .components import components, extended
from .simhash import near_duplicates

WIDTH = 5
#: Numerator and denominator of the least share of common shingles.
SHARE = (4, 5)
#: Shingles gathered before they are dealt out.
GATHERED = 1 << 20
#: A shingle counts for the list of frequent ones where ``GATHERED`` hold it this often, and is
#: on it with that many in all of ``GATHERED``: at most ``GATHERED`` / ``OFTEN`` entries.
OFTEN = 4
#: Bytes of shingles of one part of the hash range.
PART_BYTES = 24 << 20
#: A part is sorted in slices by the first bits of its shingles, so that a task needs little more
#: than the part itself.
SLICE_BITS = 3


def text_key(text: str = "text") -> Column:
    """Hash that stands for a text; null is the empty text."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text.

    A shorter text is one shingle; texts without words have the shingle zero.
    """
    found = text.lower().split() if text else []
    if not found:
        return np.zeros(1, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = min(WIDTH, len(found)) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(found) - last].tolist(), ends[last:].tolist(), strict=True)
    return np.unique(np.array([digest(joined[a:b]) for a, b in spans], np.uint64))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys of texts, sizes of their sets, and the sets one after the other."""
    nodes: list[int] = []
    sets: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for node, text in zip(batch.column(0).to_pylist(), byte_strings(batch.column(1)), strict=True):
            nodes.append(node)
            sets.append(shingles(text))
            held += len(sets[-1])
            if held >= GATHERED:
                yield np.array(nodes, np.int64), np.array([len(s) for s in sets], np.int64), np.concatenate(sets)
                nodes, sets, held = [], [], 0
    if nodes:
        yield np.array(nodes, np.int64), np.array([len(s) for s in sets], np.int64), np.concatenate(sets)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shingle, texts that hold it); the null shingle stands for all."""
    for _, _, hashes in _gathered(batches):
        found, n = np.unique(hashes, return_counts=True)
        often = n >= OFTEN
        keys = pa.array([None, *found[often].view(np.int64).tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays([keys, pa.array([len(hashes), *n[often].tolist()], pa.int64())], ["shingle", "n"])


def frequent(texts: DataFrame) -> tuple[np.ndarray, int]:
    """The shingles held by a large share of all texts, sorted, and the number of all shingles.

    The list only says what is kept out of the parts of the hash range and ordered last, so
    that no part grows with a passage that many texts share; no result depends on it.
    """
    counted = written(texts.mapInArrow(_counts, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")))
    total = counted.where("shingle is null").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rows = counted.where(F.col("shingle").isNotNull() & (F.col("n") * GATHERED >= OFTEN * total)).select("shingle").toArrow()
    return np.sort(rows.column(0).to_numpy().astype(np.int64).view(np.uint64)), total


def _within(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which of the hashes are among the known sorted ones."""
    if not len(known):
        return np.zeros(len(hashes), bool)
    return known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes


_DEALT = "part long, nodes binary, counts binary, sizes binary, hashes binary"


def _dealt(often, parts: int):
    """Deals the shingles of gathered texts to the parts of the hash range.

    A row holds the keys of texts, how many shingles of each are in this part, and these.
    Parts from ``parts`` on hold the sizes of the sets and their frequent shingles instead.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = often()
        for nodes, sizes, hashes in _gathered(batches):
            _, first_of = np.unique(nodes, return_index=True)
            single = np.zeros(len(nodes), bool)  # copies among the gathered texts go as one
            single[first_of] = True
            nodes, sizes, hashes = nodes[single], sizes[single], hashes[np.repeat(single, sizes)]
            owner = np.repeat(np.arange(len(nodes)), sizes)
            heavy = _within(hashes, known)
            of_each = np.bincount(owner[heavy], minlength=len(nodes))
            first = parts + int(nodes[0]) % parts
            rows = [(first, nodes.tobytes(), of_each.tobytes(), sizes.tobytes(), hashes[heavy].tobytes())]
            hashes, owner = hashes[~heavy], owner[~heavy]
            part = (hashes % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            hashes, owner, part = hashes[order], owner[order], part[order]
            cuts = np.searchsorted(part, np.arange(parts + 1))
            for k, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist(), strict=False)):
                if a < b:
                    who, n = np.unique(owner[a:b], return_counts=True)
                    rows.append((k, nodes[who].tobytes(), n.astype(np.int64).tobytes(), None, hashes[a:b].tobytes()))
            kinds = [pa.int64()] + [pa.binary()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "nodes", "counts", "sizes", "hashes"])

    return run


_SHARED = "home long, nodes binary, counts binary, sizes binary, hashes binary, held binary"
_LAST = np.iinfo(np.int64).max


def _sent_home(homes: int, nodes: np.ndarray, counts: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, held: np.ndarray) -> pa.RecordBatch:
    """A row for each of the homes that the texts are dealt to, with all that goes there."""
    home = nodes % homes
    order = np.argsort(home, kind="stable")
    begins = np.cumsum(counts) - counts
    counts_in = counts[order]
    # Places of the shingles of the texts in their new order.
    places = np.repeat(begins[order] - (np.cumsum(counts_in) - counts_in), counts_in) + np.arange(counts_in.sum())
    home, nodes, sizes, hashes, held = home[order], nodes[order], sizes[order], hashes[places], held[places]
    cuts = np.append(np.flatnonzero(np.diff(home, prepend=-1)), len(home))
    inner = np.append(0, np.cumsum(counts_in))[cuts]
    rows = []
    for a, b, x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), inner[:-1].tolist(), inner[1:].tolist(), strict=True):
        rows.append((int(home[a]), nodes[a:b].tobytes(), counts_in[a:b].tobytes(), sizes[a:b].tobytes(), hashes[x:y].tobytes(), held[x:y].tobytes()))
    kinds = [pa.int64()] + [pa.binary()] * 5
    columns = zip(*rows, strict=True) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["home", "nodes", "counts", "sizes", "hashes", "held"])


def _values(blob: pa.Scalar, kind: type) -> np.ndarray:
    """The numbers of a binary value, without copying them."""
    return np.frombuffer(blob.as_buffer(), kind) if len(blob.as_buffer()) else np.zeros(0, kind)


def _repeated(parts: int):
    """Rows sorted by part: the shingles of texts that other texts hold too, with how many do.

    What belongs to a text goes to its home, one of as many as there are parts, in one row per
    part and home.
    """

    def slice_rows(rows: list[tuple], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts, shingles and numbers of texts for the shingles of a slice, sorted by shingle."""
        inside = [hashes >> np.uint64(64 - SLICE_BITS) == np.uint64(k) for _, _, hashes in rows]
        nodes = np.concatenate([np.repeat(nodes, counts)[own] for (nodes, counts, _), own in zip(rows, inside, strict=True)])
        hashes = np.concatenate([hashes[own] for (_, _, hashes), own in zip(rows, inside, strict=True)])
        order = np.lexsort((nodes, hashes))
        nodes, hashes = nodes[order], hashes[order]
        new = np.ones(len(nodes), bool)  # copies of a text count once
        new[1:] = (nodes[1:] != nodes[:-1]) | (hashes[1:] != hashes[:-1])
        nodes, hashes = nodes[new], hashes[new]
        runs = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
        n = np.diff(np.append(runs, len(hashes)))
        held = np.repeat(n, n)
        several = held > 1
        return nodes[several], hashes[several], held[several]

    def part_rows(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        nodes, hashes, held = (np.concatenate(c) for c in zip(*[slice_rows(rows, k) for k in range(1 << SLICE_BITS)], strict=True))
        order = np.argsort(nodes, kind="stable")
        nodes, hashes, held = nodes[order], hashes[order], held[order]
        if len(nodes):
            who, counts = np.unique(nodes, return_counts=True)
            yield _sent_home(parts, who, counts, np.zeros(len(who), np.int64), hashes, held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        at = None
        for batch in batches:
            for i, part in enumerate(batch.column(0).to_pylist()):
                nodes, counts, hashes = (_values(batch.column(c)[i], kind) for c, kind in ((1, np.int64), (2, np.int64), (4, np.uint64)))
                if part >= parts:
                    yield _sent_home(parts, nodes, counts, _values(batch.column(3)[i], np.int64), hashes, np.full(len(hashes), _LAST))
                    continue
                if part != at and rows:
                    yield from part_rows(rows)
                    rows = []
                at = part
                rows.append((nodes, counts, hashes))
        if rows:
            yield from part_rows(rows)

    return run


_KEYED = "node long, n long, found binary, keys array<struct<key: long, pos: long>>"


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by home: texts that can link at all, with the shared shingles among their rarest ones."""

    def texts_of(rows: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        nodes, counts, sizes, hashes, held = (np.concatenate(c) for c in zip(*rows, strict=True))
        who, place = np.unique(nodes, return_inverse=True)
        size = np.zeros(len(who), np.int64)
        np.maximum.at(size, place, sizes)
        owner = np.repeat(place, counts)
        order = np.lexsort((hashes, held, owner))
        owner, hashes, held = owner[order], hashes[order], held[order]
        ends = np.searchsorted(owner, np.arange(len(who) + 1)).tolist()
        out = []
        for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            n = int(size[k])
            alone, least = n - (b - a), -(-SHARE[0] * n // SHARE[1])
            if alone > n - least:
                continue
            rarest = hashes[a:b][: n - least + 1 - alone].view(np.int64).tolist()
            keys = [{"key": key, "pos": alone + i} for i, key in enumerate(rarest)]
            out.append((int(who[k]), n, np.sort(hashes[a:b]).tobytes(), keys))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("key", pa.int64()), ("pos", pa.int64())]))]
        for at in range(0, len(out), 1024):
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out[at : at + 1024], strict=True), kinds, strict=True)], ["node", "n", "found", "keys"])

    rows: list[tuple[np.ndarray, ...]] = []
    sized: set[int] = set()
    at = None
    for batch in batches:
        for home, *blobs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if home != at and rows:
                yield from texts_of(rows)
                rows, sized = [], set()
            at = home
            nodes, counts, sizes, hashes, held = (np.frombuffer(x, t) for x, t in zip(blobs, (np.int64, np.int64, np.int64, np.uint64, np.int64), strict=True))
            if sizes[0]:  # sizes and frequent shingles come once for every run of copies: the first one counts
                new = np.array([n not in sized for n in nodes.tolist()], bool)
                sized.update(nodes.tolist())
                if not new.all():
                    kept = np.repeat(new, counts)
                    nodes, counts, sizes, hashes, held = nodes[new], counts[new], sizes[new], hashes[kept], held[kept]
            if len(nodes):
                rows.append((nodes, counts, sizes, hashes, held))
    if rows:
        yield from texts_of(rows)


def prefixes(documents: DataFrame) -> DataFrame:
    """``node``, ``n`` (size of its set), ``found`` (its shared shingles), ``keys`` (key, pos)."""
    spark = documents.sparkSession
    texts = documents.select(text_key().alias("node"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    often, total = frequent(texts)
    parts = total * 10 // PART_BYTES + 1
    dealt = texts.mapInArrow(_dealt(shipped(spark, often), parts), _DEALT)
    shared = dealt.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_repeated(parts), _SHARED)
    return written(shared.repartition(parts, "home").sortWithinPartitions("home").mapInArrow(_prefixes, _KEYED))


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, sizes of both sets, shared shingles of both): the pairs that share enough."""
    for batch in batches:
        good = []
        for m, n, x, y in zip(*[c.to_pylist() for c in batch.columns[2:]], strict=True):
            both = np.sort(np.frombuffer(x + y, np.uint64))
            common = int((both[1:] == both[:-1]).sum())
            good.append(SHARE[1] * common >= SHARE[0] * (m + n - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))


def linked(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of text keys whose sets of shingles share enough."""
    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("found").alias("right")), "b")
    both = both.join(texts.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("found").alias("left")), "a")
    return written(both.select("a", "b", "na", "nb", "left", "right").mapInArrow(_linked, "a long, b long"))


def _may_link(a: str, b: str) -> Column:
    """Whether what follows the key in both sets is enough for a link, with ``a`` no larger than ``b``.

    With the share s / t, sets of sizes m and n link if they have at least s (m + n) / (s + t)
    shingles in common; of these none comes before the first common key.
    """
    s, t = SHARE
    m, n = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = s * (m + n)
    return (t * m >= s * n) & ((s + t) * (m - F.col(f"{a}.pos")) >= need) & ((s + t) * (n - F.col(f"{b}.pos")) >= need)


def _ordered(x: str, y: str) -> Column:
    return F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).alias("p")


def _grouped(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """Rows of keys whose texts are not yet in one group, with the ``root`` of each text's group."""
    placed = written(shared.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node")))
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key")
    return written(placed.join(mixed, "key"))


def fingerprint_links(documents: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts that SimHash puts in one component and whose sets share enough.

    Each text of a component is checked against its least one, ``a``, so no component makes more
    pairs than it has texts. A text that links to another one of them only is left to the filter.
    """
    found = near_duplicates(documents.select(text_key().alias("doc_id"), "text"), WIDTH)
    close = found.where("doc_id <> component_id").select(_ordered("doc_id", "component_id")).select("p.*").distinct()
    return linked(texts, written(close))


def groups(documents: DataFrame) -> DataFrame:
    """``node`` (the key of a text) and ``root`` (the least key of its group), for linked texts."""
    texts = prefixes(documents)
    close = fingerprint_links(documents, texts)
    # Stars around the least text of a component of fingerprints: no rounds are needed to place them.
    placed = close.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(close.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
    shared = texts.select("node", "n", F.explode("keys").alias("k")).select("k.key", "node", "n", "k.pos")
    # A text that is the smaller one of a link has the key among its first ninth; it can lead.
    # Of these the one with the fewest rarer shingles leads: the one that others are copies of.
    s, t = SHARE
    text, left = F.struct("pos", "n", "node"), F.col("n") - F.col("pos")
    can_lead = (s + t) * left >= 2 * s * F.col("n")
    leads = shared.groupBy("key").agg(F.min(F.when(can_lead, text)).alias("lead"), F.count("*").alias("texts"))
    shared = written(shared.join(leads.where("texts > 1 and lead is not null").select("key", "lead"), "key"))
    star = shared.withColumn("own", text).where("node <> lead.node").where(_may_link("lead", "own") | _may_link("own", "lead"))
    star = star.select(F.col("lead.node").alias("first"), "node").distinct()
    for side in ("first", "node"):
        star = star.join(placed.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
    apart = "coalesce(first_root, first) <> coalesce(node_root, node)"
    tried = written(star.where(apart).select(_ordered("first", "node")).select("p.*").distinct())
    joined = components(linked(texts, tried).unionByName(close))
    # Keys with several groups: pairs of groups that sizes and positions allow, then of their texts.
    rest = _grouped(shared.drop("lead"), joined)
    bounds = [F.min("n").alias("low"), F.max("n").alias("high"), F.max(left).alias("left")]
    small = rest.where(can_lead).groupBy("key", F.col("root").alias("ra")).agg(F.struct(*bounds).alias("x"))
    large = rest.groupBy("key", F.col("root").alias("rb")).agg(F.struct(*bounds).alias("y"))
    need = s * (F.col("x.low") + F.col("y.low"))
    fits = ((s + t) * F.col("x.left") >= need) & ((s + t) * F.col("y.left") >= need) & (t * F.col("x.high") >= s * F.col("y.low")) & (F.col("x.low") <= F.col("y.high"))
    roots = written(small.join(large, "key").where((F.col("ra") != F.col("rb")) & fits).select("key", "ra", "rb"))
    across = roots.join(rest.where(can_lead).select("key", F.col("root").alias("ra"), text.alias("x")), ["key", "ra"])
    across = across.join(rest.select("key", F.col("root").alias("rb"), text.alias("y")), ["key", "rb"]).where(_may_link("x", "y"))
    smaller = F.struct(F.col("x.n"), F.col("x.node")) < F.struct(F.col("y.n"), F.col("y.node"))
    pairs = across.where(smaller).select(_ordered("x.node", "y.node")).select("p.*").distinct()
    more = linked(texts, written(pairs.join(tried.unionByName(close), ["a", "b"], "left_anti")))
    return extended(joined, more)


def one_row_of_each(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` of which one of each group of near copies stays.

    The row with the smallest doc_id of its group stays, one with a null id only if there is
    no other; of several rows with that id, one by a hash of the row. All columns are kept,
    whatever their names. Texts without words, null ones too, are copies of each other. A text
    counts whole, however long. An empty table gives an empty result.
    """
    mark = "_"
    while any(c.startswith(mark) for c in documents.columns):
        mark += "_"
    at, own, copies, key = (f"{mark}{name}" for name in ("id", "row", "copies", "key"))
    row = F.xxhash64(*documents.columns)
    marked = documents.select(F.col("doc_id").alias(at), text_key().alias("node"), row.alias(own))
    counted = marked.groupBy("node", at, own).agg(F.count("*").alias(copies))
    counted = counted.join(groups(documents), "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = F.min(F.struct(F.col(at).isNull().alias("null"), at, own, copies)).alias("r")
    kept = written(counted.groupBy("root").agg(first).select(f"r.{at}", f"r.{own}", f"r.{copies}"))
    rows = documents.withColumn(key, row).join(kept, F.col("doc_id").eqNullSafe(F.col(at)) & (F.col(key) == F.col(own)))
    single = rows.where(F.col(copies) == 1).select(documents.columns)
    several = rows.where(F.col(copies) > 1).groupBy(key).agg(F.min(F.struct(*documents.columns)).alias("r")).select("r.*")
    return single.unionByName(several)
