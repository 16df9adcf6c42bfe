"""Cross-tokenizer alignment by an associative monoid of fragments.

Two tokenizers cut the same bytes into tokens. Places where a token of both ends cut the tokens
into groups; every A token of a group is linked to every B token of it.

A ``Fragment`` is what a byte range of a text says about that: the tokens that end in the range,
as an open prefix (up to the first common end), closed groups, and an open suffix (after the
last common end). ``compose`` joins the fragments of neighbouring ranges, whatever their
bounds: a suffix and the prefix after it become a group. It is associative and ``EMPTY`` is its
neutral element, so the ranges of a very long text are tokenized in separate Spark tasks and
composed as a tree.

Both tokenizers always cut before a space that follows something other than white space
(``Aligner`` proves it from B's vocabulary; A's pattern has no token that runs on into a space).
Such units are closed fragments that depend on nothing around them. Their fragments are
remembered, so most of a text is composed without any tokenizing. A byte range that begins or
ends within a unit keeps the unit's tokens that end in the range.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import written
from .tokens import load

#: Texts of more bytes are dealt out to tasks in ranges of this size.
RANGE_BYTES = 1 << 16
#: Fragments that one task composes in a step of the tree.
FAN = 16
#: Units a task remembers.
REMEMBERED = 250_000
#: Characters of all remembered units together.
REMEMBERED_TEXT = 16_000_000
#: Pairs with at least this share of all (document, pair) rows are broadcast: at most 2**19 of them.
HEAD = 1 << 19

_CUT = re.compile(r"(?<=\S)(?= )")
_SPACED = re.compile(r"\s ")
_NONE = np.zeros(0, np.int64)


class Fragment(NamedTuple):
    """Tokens that end in a byte range; ``pairs`` are distinct links of the closed groups."""

    bad: bool  # the bytes of the tokens are not those of the text
    cut: bool  # holds a common end; without one all tokens are in the prefix
    head_a: tuple[int, ...]
    head_b: tuple[int, ...]
    text: str  # closed groups, joined by ";"
    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    pairs: np.ndarray
    times: np.ndarray
    tail_a: tuple[int, ...]
    tail_b: tuple[int, ...]


EMPTY = Fragment(False, False, (), (), "", 0, 0, 0, 0, _NONE, _NONE, (), ())


def counted(pairs: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, and how often each occurs."""
    if not len(pairs):
        return _NONE, _NONE
    if times is None:
        return np.unique(pairs, return_counts=True)
    order = np.argsort(pairs, kind="stable")
    pairs, times = pairs[order], times[order]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    return pairs[first], np.add.reduceat(times, first)


def group(a: tuple[int, ...], b: tuple[int, ...]) -> Fragment:
    """One closed group."""
    links = (np.repeat(np.array(a, np.int64), len(b)) << 32) | np.tile(np.array(b, np.int64), len(a))
    text = f"{','.join(map(str, a))}|{','.join(map(str, b))}"
    return Fragment(False, True, (), (), text, len(a), len(b), 1, len(a) * len(b), *counted(links), (), ())


def _closed(parts: list[Fragment]) -> dict:
    """The closed groups of fragments put one after the other."""
    pairs, times = counted(np.concatenate([p.pairs for p in parts]), np.concatenate([p.times for p in parts]))
    sums = {n: sum(getattr(p, n) for p in parts) for n in ("n_a", "n_b", "n_groups", "n_links")}
    return {"text": ";".join(p.text for p in parts if p.n_groups), "pairs": pairs, "times": times, **sums}


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    bad = x.bad or y.bad
    if not x.cut:
        return y._replace(bad=bad, head_a=x.head_a + y.head_a, head_b=x.head_b + y.head_b)
    if not y.cut:
        return x._replace(bad=bad, tail_a=x.tail_a + y.head_a, tail_b=x.tail_b + y.head_b)
    middle = group(x.tail_a + y.head_a, x.tail_b + y.head_b) if x.tail_a or x.tail_b or y.head_a or y.head_b else EMPTY
    return Fragment(bad, True, x.head_a, x.head_b, tail_a=y.tail_a, tail_b=y.tail_b, **_closed([x, middle, y]))


def whole(x: Fragment) -> Fragment:
    """The fragment of a whole text: its prefix is a group too."""
    return compose(EMPTY._replace(cut=True), x)


def units_of(text: str) -> list[str]:
    """The text cut before each space that follows something other than white space."""
    if not text:
        return []
    if _SPACED.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [*([first] if first else []), *[" " + r for r in rest]]


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary (fixed by the format)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Aligner:
    """Fragments of texts under two tokenizers; remembers the fragments of short units."""

    def __init__(self, path_a: str, path_b: str, remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        import sentencepiece

        self.a, _ = load(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of, vocabulary = _byte_of(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, k in vocabulary.items():
            # Special entries are no byte strings; they never come out of plain text.
            self.bytes_a[k] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path_b} has pieces that run on into a space")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id("▁")
        self.bound = remembered
        self.place: dict[str, int] = {}
        self._clear()

    def _clear(self) -> None:
        self.place.clear()
        self.held = 0
        self.texts: list[str] = []
        self.facts = np.zeros((1024, 6), np.int64)  # bad, n_a, n_b, n_groups, n_links, end of its links
        self.links = np.zeros(4096, np.int64)

    def _encoded(self, units: list[str]) -> Iterator[tuple[list[int], list[int], bool]]:
        """Ids of both tokenizers for each unit, and whether their bytes are the unit's."""
        found = self.a.encode_batch_fast(units, add_special_tokens=False)
        # B puts a space in front of what it is given.
        for unit, x, b in zip(units, found, self.b.encode([u[1:] for u in units], num_threads=1), strict=True):
            a, data = x.ids, unit.encode()
            b = b or [self.space]  # a lone space at the end of a text
            yield a, b, b"".join([self.bytes_a[k] for k in a]) == data and b"".join([self.bytes_b[k] for k in b]) == data

    def tokens_between(self, units: list[str], low: int, high: int) -> tuple[bool, list[int], np.ndarray, list[int], np.ndarray]:
        """Tokens of units in sequence that end in the byte range (low, high], and their ends."""
        ids_a, ids_b, fits = [], [], True
        for a, b, same in self._encoded(units):
            ids_a += a
            ids_b += b
            fits = fits and same
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        in_a, in_b = (end_a > low) & (end_a <= high), (end_b > low) & (end_b <= high)
        return not fits, a[in_a].tolist(), end_a[in_a], b[in_b].tolist(), end_b[in_b]

    def part(self, unit: str, low: int, high: int) -> Fragment:
        """The fragment of the byte range (low, high] of one unit."""
        bad, a, end_a, b, end_b = self.tokens_between([unit], low, high)
        if bad:
            return EMPTY._replace(bad=True)
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        if not len(common):
            return EMPTY._replace(head_a=tuple(a), head_b=tuple(b))
        cut_a, cut_b = np.searchsorted(end_a, common, "right"), np.searchsorted(end_b, common, "right")
        groups = [
            group(tuple(a[p:q]), tuple(b[r:s]))
            for p, q, r, s in zip(cut_a, cut_a[1:], cut_b, cut_b[1:], strict=False)
        ]
        closed = _closed([EMPTY, *groups])
        ends = {"tail_a": tuple(a[cut_a[-1] :]), "tail_b": tuple(b[cut_b[-1] :])}
        return Fragment(False, True, tuple(a[: cut_a[0]]), tuple(b[: cut_b[0]]), **closed, **ends)

    def _learn(self, units: list[str]) -> None:
        """Remember the closed fragments of units, all groups found together."""
        begin = len(self.texts)
        while begin + len(units) > len(self.facts):
            self.facts = np.concatenate([self.facts, np.zeros_like(self.facts)])
        all_a, all_b, n = [], [], np.zeros((len(units), 2), np.int64)
        for k, (a, b, same) in enumerate(self._encoded(units)):
            if same:
                all_a += a
                all_b += b
                n[k] = len(a), len(b)
            else:
                self.facts[begin + k, 0] = 1
        a, b = np.array(all_a, np.int64), np.array(all_b, np.int64)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        in_a, in_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)  # group of each token
        many_a, many_b = np.bincount(in_a, minlength=len(common)), np.bincount(in_b, minlength=len(common))
        start_a, start_b = np.cumsum(many_a) - many_a, np.cumsum(many_b) - many_b
        # Links: each A token with all B tokens of its group.
        width = many_b[in_a]
        partner = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width) + np.repeat(start_b[in_a], width)
        links = (np.repeat(a, width) << 32) | b[partner]
        # Written form: a token's place is that of the A and B tokens before it in group order.
        parts = np.empty(len(a) + len(b), object)
        last_a, last_b = np.r_[in_a[1:] != in_a[:-1], True][: len(a)], np.r_[in_b[1:] != in_b[:-1], True][: len(b)]
        parts[np.arange(len(a)) + start_b[in_a]] = [f"{k}|" if e else f"{k}," for k, e in zip(all_a, last_a.tolist(), strict=True)]
        parts[np.arange(len(b)) + (start_a + many_a)[in_b]] = [f"{k};" if e else f"{k}," for k, e in zip(all_b, last_b.tolist(), strict=True)]
        shown, last = parts.tolist(), np.cumsum(n, axis=0)
        both = last.sum(axis=1).tolist()
        self.texts += ["".join(shown[i:j])[:-1] for i, j in zip([0, *both], both, strict=False)]
        upto = np.r_[0, np.cumsum(width)][last[:, 0]]  # links up to the end of each unit
        upto_groups = np.r_[0, in_a + 1][last[:, 0]]
        old, facts = int(self.facts[begin - 1, 5]) if begin else 0, self.facts[begin : begin + len(units)]
        facts[:, 1:3] = n
        facts[:, 3] = np.diff(np.r_[0, upto_groups])
        facts[:, 4] = np.diff(np.r_[0, upto])
        facts[:, 5] = old + upto
        while old + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.links[old : old + len(links)] = links
        self.place.update(zip(units, range(begin, begin + len(units)), strict=True))
        self.held += sum(map(len, units))

    def closed(self, texts: list[list[str]]) -> list[Fragment]:
        """The fragments of texts given as units, none of them open."""
        flat = [u for t in texts for u in t]
        new = set(flat).difference(self.place)
        if new and len(self.place) + len(new) > self.bound:
            self._clear()
            new = set(flat)
        if new:
            self._learn(sorted(new))
        at = np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat))
        which = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        facts = self.facts[at]
        # Exact: the weights are small whole numbers.
        sums = np.stack([np.bincount(which, facts[:, k], len(texts)) for k in range(5)], axis=1).astype(np.int64)
        width = facts[:, 4]
        ends = np.cumsum(width)
        links = self.links[np.arange(ends[-1] if len(ends) else 0) + np.repeat(facts[:, 5] - ends, width)]
        bounds, shown, out = np.r_[0, np.cumsum(sums[:, 4])], list(map(self.texts.__getitem__, at.tolist())), []
        begin = 0
        for k, text in enumerate(texts):
            end = begin + len(text)
            line = ";".join(filter(None, shown[begin:end]))
            out.append(Fragment(bool(sums[k, 0]), bool(sums[k, 3]), (), (), line, *sums[k, 1:].tolist(), *counted(links[bounds[k] : bounds[k + 1]]), (), ()))
            begin = end
        if len(self.place) > self.bound or self.held > REMEMBERED_TEXT:
            self._clear()
        return out

    def texts_of(self, texts: list[str | None]) -> list[Fragment]:
        """The fragments of whole texts; a null or empty one has no tokens."""
        return self.closed([units_of(" " + t) if t else [] for t in texts])

    def range_of(self, text: str, low: int, high: int) -> Fragment:
        """The fragment of the bytes (low, high] of a text that begins with a unit."""
        units = units_of(text)
        if len(units) == 1:
            return self.part(units[0], low, high)
        size = len(text.encode())
        before, after = len(units[0].encode()), size - len(units[-1].encode())
        first = self.part(units[0], low, before) if low > 0 else self.closed([units[:1]])[0]
        last = self.part(units[-1], 0, high - after) if high < size else self.closed([units[-1:]])[0]
        return reduce(compose, [first, *self.closed([units[1:-1]]), last])


def ranges(text: str, size: int = RANGE_BYTES) -> Iterator[tuple[str, int, int]]:
    """Byte ranges of a text: the units they touch, and the range's bounds in these.

    A bound that falls into a unit of more than a quarter of ``size`` moves to its end, so that
    no very long unit is tokenized several times.
    """
    units = units_of(" " + text)
    end = np.cumsum([len(u.encode()) for u in units])
    start = np.r_[0, end[:-1]]
    low = 0
    while low < end[-1]:
        high = min(low + size, int(end[-1]))
        k = int(np.searchsorted(end, high))
        if end[k] - start[k] > size // 4:
            high = int(end[k])
        first = int(np.searchsorted(end, low, "right"))
        yield "".join(units[first : k + 1]), low - int(start[first]), high - int(start[first])
        low = high


_FRAGMENT = (
    "bad boolean, cut boolean, head_a array<bigint>, head_b array<bigint>, text string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "pairs array<bigint>, times array<bigint>, tail_a array<bigint>, tail_b array<bigint>"
)
_KINDS = [pa.bool_()] * 2 + [pa.list_(pa.int64())] * 2 + [pa.string()] + [pa.int64()] * 4 + [pa.list_(pa.int64())] * 4


def _columns(fragments: list[Fragment]) -> list[pa.Array]:
    return [pa.array([list(v) if isinstance(v, tuple) else v for v in c], k) for c, k in zip(zip(*fragments, strict=True), _KINDS, strict=True)]


def _read(row: dict) -> Fragment:
    values = {n: tuple(row[n]) if n.startswith(("head", "tail")) else row[n] for n in Fragment._fields}
    return Fragment(**values | {n: np.array(row[n], np.int64) for n in ("pairs", "times")})


def _results(ids: pa.Array, fragments: list[Fragment]) -> pa.RecordBatch:
    """One row per text; without tokens of the same bytes everything is zero."""
    done = [EMPTY if f.bad else f for f in fragments]
    sizes = np.r_[0, np.cumsum([len(f.pairs) for f in done])].astype(np.int32)
    lists = [pa.ListArray.from_arrays(sizes, np.concatenate([_NONE, *[getattr(f, n) for f in done]])) for n in ("pairs", "times")]
    numbers = [pa.array([getattr(f, n) for f in done], pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    digests = pa.array([hashlib.sha256(f.text.encode()).hexdigest() if f.n_groups else "" for f in done], pa.string())
    return pa.RecordBatch.from_arrays([ids, *numbers, digests, *lists], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def aligned(documents: DataFrame, path_a: str, path_b: str, size: int = RANGE_BYTES) -> DataFrame:
    """One row per document: ``doc_id``, counts, the digest of its groups, ``pairs`` and ``times``.

    ``pairs`` are the document's distinct links, A id times 2**32 plus B id, ``times`` how often
    each occurs. Both tokenizers read a space and the text. A null or empty text, and one whose
    tokens have other bytes (B may replace characters), has zeros, an empty digest and no pairs. Null
    and repeated ids and repeated rows keep a row each; other columns are left out, so their
    names cannot clash. Texts of more than ``size`` bytes are dealt out in byte ranges; the
    result does not depend on ``size``. A run without spaces is tokenized in one piece.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"
    texts = documents.select("doc_id", "text")
    is_long = F.coalesce(F.octet_length("text") > size, F.lit(False))

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                yield _results(some.column(0), aligner.texts_of(some.column(1).to_pylist()))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = [{"row": row["row"], "doc_id": row["doc_id"], "at": k, "text": t, "low": a, "high": b} for k, (t, a, b) in enumerate(ranges(row["text"], size))]
                for at in range(0, len(found), 256):
                    yield pa.RecordBatch.from_pylist(found[at : at + 256], schema)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                found = [aligner.range_of(*v) for v in zip(*(some.column(n).to_pylist() for n in ("text", "low", "high")), strict=True)]
                yield pa.RecordBatch.from_arrays([*[some.column(n) for n in ("row", "doc_id", "at")], *_columns(found)], ["row", "doc_id", "at", *Fragment._fields])

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["at"])
        top = reduce(compose, map(_read, rows))
        ids = [pa.array([rows[0][n]], table.schema.field(n).type) for n in ("row", "doc_id")]
        return pa.Table.from_arrays([*ids, pa.array([rows[0]["at"] // FAN], pa.int64()), *_columns([top])], ["row", "doc_id", "at", *Fragment._fields])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                some = batch.slice(at, 1)
                yield _results(some.column("doc_id"), [whole(_read(some.to_pylist()[0]))])

    rows = texts.where(is_long).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    schema = pa.schema([("row", pa.int64()), ("doc_id", to_arrow_type(documents.schema["doc_id"].dataType)), ("at", pa.int64()), ("text", pa.string()), ("low", pa.int64()), ("high", pa.int64())])
    # Written, as row numbers must stay when a task is run again.
    cut = written(rows.mapInArrow(split, f"row bigint, doc_id {kind}, at bigint, text string, low bigint, high bigint"))
    keys = f"row bigint, doc_id {kind}, at bigint"
    level = cut.repartition("row", "at").mapInArrow(measure, f"{keys}, {_FRAGMENT}")
    left = 1 + (cut.agg(F.max("at")).first()[0] or 0)
    while left > 1:
        level = level.groupBy("row", F.expr(f"at div {FAN}").alias("_part")).applyInArrow(join, f"{keys}, {_FRAGMENT}")
        left = -(-left // FAN)
    return texts.where(~is_long).mapInArrow(short, out).unionByName(level.mapInArrow(finish, out))


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair``, ``n`` (documents that hold it) and ``best`` (no pair of its A id has a larger n)."""
    counts = written(found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")))
    a = F.shiftright("pair", 32)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counts.select(a.alias("a"), "pair", "n").join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment(documents: DataFrame, path_a: str, path_b: str, size: int = RANGE_BYTES) -> DataFrame:
    """``aligned`` without the pairs, but with ``n_best`` and ``count_sum`` over each document's links.

    A pair's count is the number of documents that hold it. Pairs are unbounded in number: those
    that hold at least 1 in ``HEAD`` of all (document, pair) rows, which can be no more than ``HEAD``,
    are broadcast; the others are joined by shuffle, and none of them is a hot key.
    """
    row = F.monotonically_increasing_id()
    found = written(aligned(documents, path_a, path_b, size).withColumn("row", row))
    counts = written(pair_counts(found))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    frequent = F.col("n") * HEAD >= total
    head, tail = F.broadcast(counts.where(frequent)), counts.where(~frequent)
    links = found.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    known = links.join(head, "pair").unionByName(links.join(head.select("pair"), "pair", "left_anti").join(tail, "pair"))
    sums = known.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    zero = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_best", "count_sum")]
    return found.drop("pairs", "times").join(sums, "row", "left").select("doc_id", *numbers, *zero, "groups_sha256")
