"""Language-model scores of documents: a log-bilinear model trained by noise contrast.

Words are unbounded in number, so the model works on units. The ``WORDS`` most frequent words are
a unit each; every other word belongs to one of ``SPELLINGS`` units by its last letters. A
word's probability is that of its unit after the words before it, times the word's
smoothed share of its unit's counts. Both factors add up to one, with one unknown word per
spelling unit.

The unit's score after a context is bilinear: the context words' vectors, each times the weights
of its position, are added up and multiplied with the unit's vector. Training contrasts each
word with words drawn from the unit frequencies (noise-contrastive estimation), so it never sums
over all units. Scoring does: a matrix product gives all units' scores, and their sum the
normaliser.

Word counts are exact and cover the whole corpus. With them every text is turned into units once;
training and scoring read these. Training reads every training document once, in
three rounds of growing size. In a round every task trains its own copy on its rows,
in numpy; the copies are averaged by a tree of groups. Nothing is held that grows with the corpus:
frequent words are broadcast, at most ``HEAD`` of them, and the counts of the others are joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staywise.functions.shipping import shipped

from .common import byte_strings, written

#: Words that are a unit each.
WORDS = 64
#: Units of all other words, by spelling.
SPELLINGS = 256
#: Words before a word that its probability depends on.
CONTEXT = 4
#: Length of the vectors.
WIDTH = 16
#: Noise units drawn for a batch of words.
NOISE = 32
RATE = 0.15
#: Sixteenths of the training documents that the rounds read, and words in a batch.
ROUNDS = ((1, 256), (3, 512), (12, 2048))
#: Words that make up at least this share of all words are broadcast: at most 2**17 of them.
HEAD = 1 << 17
#: Distinct words whose counts a task holds before it hands them on.
HELD = 400_000
#: Copies of the model that one task averages in a step of the tree.
FAN = 32
#: The end of a text, which no word equals as it is white space.
END = b"\n"


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased words and the end; splits at the ASCII white space and nothing else."""
    return [*(text or b"").lower().split(), END]


def spelling(word: bytes, spellings: int = SPELLINGS) -> int:
    """The spelling unit of a word: a hash of its last three bytes that are no ASCII punctuation."""
    tail = word.rstrip(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")[-3:] or word[-3:]
    return zlib.crc32(tail) % spellings


@dataclass
class Counts:
    """What the corpus says about words; bounded by ``HEAD`` and the number of units."""

    total: int  # training words
    distinct: int  # distinct training words
    head: dict[bytes, int]  # training counts of the words that are frequent in all documents
    units: dict[bytes, int]  # words that are a unit
    unit_total: np.ndarray  # training words of each unit
    unit_distinct: np.ndarray
    spellings: int

    def unit(self, word: bytes) -> int:
        found = self.units.get(word)
        return len(self.units) + spelling(word, self.spellings) if found is None else found


@dataclass
class Model:
    """Vectors of context units (the last row stands before a text), of units, weights and biases."""

    context: np.ndarray  # (units + 1, width)
    weights: np.ndarray  # (positions, width)
    target: np.ndarray  # (units, width)
    bias: np.ndarray  # (units,)

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.weights, self.target, self.bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def filled(self, values: np.ndarray) -> Model:
        ends = np.cumsum([p.size for p in self.parts()])
        cut = np.split(values.astype(np.float32), ends[:-1])
        return Model(*[c.reshape(p.shape) for c, p in zip(cut, self.parts(), strict=True)])

    def mixed(self, contexts: np.ndarray) -> np.ndarray:
        out = self.context.take(contexts[:, 0], axis=0) * self.weights[0]
        for k in range(1, len(self.weights)):
            out += self.context.take(contexts[:, k], axis=0) * self.weights[k]
        return out

    def logs(self, contexts: np.ndarray, units: np.ndarray, rows: int = 1024) -> np.ndarray:
        """The normalised logarithm of each row's unit, in blocks that fit a processor's cache."""
        out, ones = np.empty(len(units)), np.ones(len(self.target), np.float32)
        target = np.column_stack([self.target, self.bias]).T.copy()  # the bias goes with a column of ones
        for at in range(0, len(units), rows):
            mixed = self.mixed(contexts[at : at + rows])
            found = np.column_stack([mixed, np.ones(len(mixed), np.float32)]) @ target
            found -= found.max()  # one for the block: float32 has room for the rows' differences
            own = found[np.arange(len(found)), units[at : at + rows]]
            out[at : at + rows] = own - np.log(np.exp(found, out=found) @ ones)
        return out


def started(counts: Counts, width: int = WIDTH, positions: int = CONTEXT) -> Model:
    """Small random vectors, and the units' frequencies as biases."""
    rng = np.random.default_rng(12)
    units = len(counts.unit_total)
    small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
    return Model(small(units + 1, width), np.full((positions, width), 1.0 / positions, np.float32), small(units, width), np.log(noise_of(counts)).astype(np.float32))


def noise_of(counts: Counts) -> np.ndarray:
    """Smoothed frequencies of the units."""
    return (counts.unit_total + 1.0) / (counts.unit_total.sum() + len(counts.unit_total))


def contexts_of(units: np.ndarray, ends: np.ndarray, start: int, positions: int) -> np.ndarray:
    """The units before each unit, nearest first; ``start`` where the text has none there."""
    at = np.arange(len(units)) - np.repeat(np.r_[0, ends[:-1]], np.diff(np.r_[0, ends]))
    padded = np.r_[np.full(positions, start, units.dtype), units]
    out = np.stack([padded[positions - k : len(padded) - k] for k in range(1, positions + 1)], axis=1)
    return np.where(at[:, None] >= np.arange(1, positions + 1), out, start)


def _summed(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids and the sums of their rows."""
    order = np.argsort(ids.astype(np.uint16) if ids.max() < 1 << 16 else ids, kind="stable")  # counting sort
    ids = ids.take(order)
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    return ids[first], np.add.reduceat(rows.take(order, axis=0), first, axis=0)


class Trainer:
    """Adagrad on the noise-contrastive loss; one copy per task."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int, drawn: int = NOISE, rate: float = RATE) -> None:
        self.model = Model(*[p.copy() for p in model.parts()])
        self.squares = [np.full(p.shape, 1e-6, np.float32) for p in self.model.parts()]
        self.rate, self.drawn = rate, drawn
        self.rng = np.random.default_rng(seed)
        self.edges = np.cumsum(noise)
        #: What a unit's score must exceed to count as more likely data than noise.
        self.offset = np.log(drawn * noise).astype(np.float32)

    def _move(self, part: int, slope: np.ndarray, at=slice(None)) -> None:
        values, squares = self.model.parts()[part], self.squares[part]
        squares[at] += slope * slope
        values[at] -= self.rate * slope / np.sqrt(squares[at])

    def batch(self, contexts: np.ndarray, units: np.ndarray) -> None:
        m, n = self.model, len(units)
        drawn = np.minimum(np.searchsorted(self.edges, self.rng.random(self.drawn)), len(self.edges) - 1)
        seen = [m.context.take(contexts[:, k], axis=0) for k in range(contexts.shape[1])]
        mixed = seen[0] * m.weights[0]
        for vectors, w in zip(seen[1:], m.weights[1:], strict=True):
            mixed += vectors * w
        own, against, excess = m.target.take(units, axis=0), m.target[drawn], m.bias - self.offset
        data = np.einsum("ij,ij->i", mixed, own) + excess.take(units)
        noise = mixed @ against.T + excess[drawn]
        # Slopes of the loss: data should look like data, noise like noise.
        with np.errstate(over="ignore"):  # 1 / (1 + inf) is the right 0
            data = -1 / (1 + np.exp(data)) / n
            noise = 1 / (1 + np.exp(-noise)) / n
        back = own * data[:, None] + noise @ against
        # The bias is summed with the vectors, as one more column.
        rows = np.column_stack([np.concatenate([mixed * data[:, None], noise.T @ mixed]), np.r_[data, noise.sum(axis=0)]])
        ids, slope = _summed(rows, np.r_[units, drawn])
        slope_weights = np.stack([np.einsum("ij,ij->j", back, v) for v in seen])
        before = np.concatenate([back * w for w in m.weights])
        at, slope_context = _summed(before, contexts.T.ravel())
        self._move(0, slope_context, at)
        self._move(1, slope_weights)
        self._move(2, slope[:, :-1], ids)
        self._move(3, slope[:, -1], ids)

    def text(self, contexts: np.ndarray, units: np.ndarray, size: int) -> None:
        for at in range(0, len(units), size):
            self.batch(contexts[at : at + size], units[at : at + size])


def _blocks(batches: Iterator[pa.RecordBatch], column: int, words: int = 100_000) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Rows and their words, in blocks of about so many words."""
    for batch in batches:
        begin, held, lists = 0, 0, []
        for k, text in enumerate(byte_strings(batch.column(column))):
            lists.append(words_of(text))
            held += len(lists[-1])
            if held >= words:
                yield batch.slice(begin, k + 1 - begin), lists
                begin, held, lists = k + 1, 0, []
        if lists:
            yield batch.slice(begin), lists


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text (null: empty), modulo 7: 2 marks rows the model does not learn from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 7 == 2


def word_counts(rows: DataFrame) -> DataFrame:
    """``word``, ``n`` in training rows and ``n_all`` in all rows (columns ``out``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train, rest = Counter(), Counter()

        def given() -> pa.RecordBatch:
            found = list(train.keys() | rest.keys())
            columns = [pa.array(found, pa.binary()), pa.array([train[w] for w in found], pa.int64()), pa.array([rest[w] for w in found], pa.int64())]
            train.clear()
            rest.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n", "n_rest"])

        for batch, lists in _blocks(batches, 1):
            for out, words in zip(batch.column(0).to_pylist(), lists, strict=True):
                (rest if out else train).update(words)
            if len(train) + len(rest) > HELD:
                yield given()
        yield given()

    parts = rows.select("out", "text").mapInArrow(run, "word binary, n long, n_rest long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum(F.col("n") + F.col("n_rest")).alias("n_all"))


def gathered(counts: DataFrame, words: int = WORDS, spellings: int = SPELLINGS) -> Counts:
    """The bounded part of the word counts: frequent words and sums over units."""
    total, distinct, everything = counts.agg(F.sum("n"), F.count_if(F.col("n") > 0), F.sum("n_all")).first()
    # Each holds 1 / HEAD of all words, so there are no more than HEAD.
    frequent = counts.where(F.col("n_all") * HEAD >= F.lit(everything or 0)).select("word", "n").toArrow()
    ranked = counts.where("n > 0").orderBy(F.col("word") == F.lit(END), F.desc("n"), "word").limit(words).unionByName(counts.where(F.col("word") == F.lit(END)))
    single = {bytes(r.word): r.n for r in ranked.collect()}
    units = {w: k for k, w in enumerate(sorted({END, *single}))}
    head = dict(zip(frequent["word"].to_pylist(), frequent["n"].to_pylist(), strict=True)) | {END: 0} | single
    known = list(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(known) + spellings), np.int64)
        place = {w: k for k, w in enumerate(known)}
        for batch in batches:
            found = batch.column(0).to_pylist()
            at = np.array([place[w] if w in place else len(place) + spelling(w, spellings) for w in found], np.int64)
            np.add.at(sums[0], at, batch.column(1).to_numpy())
            np.add.at(sums[1], at, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.shape[1], dtype=np.int32)), pa.array(sums[0]), pa.array(sums[1])], ["unit", "n", "v"])

    sums = counts.where("n > 0").select("word", "n").mapInArrow(run, "unit int, n long, v long").groupBy("unit").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    unit_total, unit_distinct = np.zeros((2, len(units) + spellings), np.int64)
    for r in sums.collect():  # one per unit
        unit_total[r.unit], unit_distinct[r.unit] = r.n, r.v
    return Counts(total or 0, distinct or 0, head, units, unit_total, unit_distinct, spellings)


class Lookup:
    """Units and counts of words; remembers a bounded number of words."""

    def __init__(self, counts: Counts, bound: int = 300_000) -> None:
        self.counts, self.bound = counts, bound
        self._clear()

    def _clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.units, self.n = np.zeros(1024, np.int32), np.zeros(1024, np.int64)

    def places(self, lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Places of all words of the lists in ``words``, ``units`` and ``n``, and where each list ends.

        ``n`` is the training count of a frequent word, -1 for others. Places hold until the next call.
        """
        flat = [w for words in lists for w in words]
        new = set(flat).difference(self.place)
        if len(self.place) + len(new) > self.bound:
            self._clear()
            new = set(flat)
        begin, end = len(self.words), len(self.words) + len(new)
        while end > len(self.units):
            self.units, self.n = np.resize(self.units, 2 * len(self.units)), np.resize(self.n, 2 * len(self.n))
        self.words += new
        self.units[begin:end] = [self.counts.unit(w) for w in self.words[begin:]]
        self.n[begin:end] = [self.counts.head.get(w, -1) for w in self.words[begin:]]
        self.place.update(zip(self.words[begin:], range(begin, end), strict=True))
        return np.fromiter(map(self.place.__getitem__, flat), np.int64, len(flat)), np.cumsum([len(w) for w in lists])


def _averaged(copies: DataFrame) -> np.ndarray | None:
    """The mean of models (columns ``part``, ``n`` and ``model``) weighted by ``n``, by a tree."""

    def join(table: pa.Table) -> pa.Table:
        n, models = table["n"].to_pylist(), table["model"].to_pylist()
        mean = sum(k * np.frombuffer(m, np.float64) for k, m in zip(n, models, strict=True)) / sum(n)
        return pa.table({"part": pa.array([table["part"][0].as_py() // FAN], pa.int64()), "n": pa.array([sum(n)], pa.int64()), "model": pa.array([mean.tobytes()], pa.binary())})

    copies = written(copies)
    left = 1 + (copies.agg(F.max("part")).first()[0] or 0)
    while left > 1:
        copies = copies.groupBy(F.expr(f"part div {FAN}").alias("_group")).applyInArrow(join, "part long, n long, model binary")
        left = -(-left // FAN)
    last = copies.first()
    return np.frombuffer(bytes(last.model), np.float64) if last else None


def _unit_rows(batches: Iterator[pa.RecordBatch], column: int, units: int = 200_000) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Rows, the units of all of them, and where each row's units end, in blocks."""
    for batch in batches:
        lists = batch.column(column)
        ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        flat = lists.flatten().to_numpy()
        begin = 0
        while begin < batch.num_rows:
            from_ = int(ends[begin - 1]) if begin else 0
            upto = max(begin + 1, int(np.searchsorted(ends, from_ + units, "right")))
            yield batch.slice(begin, upto - begin), flat[from_ : int(ends[upto - 1])], ends[begin:upto] - from_
            begin = upto


def trained(rows: DataFrame, counts: Counts) -> Model:
    """The model after all rounds over the training rows (columns ``out``, ``slice``, ``units``)."""
    model, noise, edge = started(counts), noise_of(counts), 0
    for number, (share, size) in enumerate(ROUNDS):
        load = shipped(rows.sparkSession, (model, noise))

        def run(batches: Iterator[pa.RecordBatch], load=load, number=number, size=size) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            begun, drawn = load()
            trainer, n, start = Trainer(begun, drawn, number), 0, len(begun.target)
            for _, units, ends in _unit_rows(batches, 0):
                trainer.text(contexts_of(units, ends, start, len(begun.weights)), units, size)
                n += len(units)
            if n:
                flat = trainer.model.flat().astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()), pa.array([flat.tobytes()], pa.binary())], ["part", "n", "model"])

        part = rows.where(~F.col("out") & F.col("slice").between(edge, edge + share - 1)).select("units")
        mean = _averaged(part.mapInArrow(run, "part long, n long, model binary"))
        model = model if mean is None else model.filled(mean)
        edge += share
    return model


def in_units(rows: DataFrame, counts: Counts) -> DataFrame:
    """Each row (columns ``doc_id``, ``out``, ``slice``, ``text``) as units, with what counts say of its words.

    ``base`` sums log10(count + 1) over the frequent words, ``spelled`` over those of them that have
    no unit of their own; ``words`` and ``times`` are the other words.
    """
    load = shipped(rows.sparkSession, counts)
    kind = rows.schema["doc_id"].dataType
    names = ["doc_id", "out", "slice", "units", "known", "base", "spelled", "words", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts = load()
        known = Lookup(facts)
        for batch, lists in _blocks(batches, 3):
            at, ends = known.places(lists)
            begins, units, n = np.r_[0, ends[:-1]], known.units[at], known.n[at]
            logs = np.log10(np.maximum(n, 0) + 1.0)
            # The other words: distinct ones of each row, and how often they occur.
            rare = np.flatnonzero(n < 0)
            keys, times = np.unique((np.searchsorted(ends, rare, "right") << 32) | at[rare], return_counts=True)
            bounds = pa.array(np.searchsorted(keys >> 32, np.arange(len(lists) + 1)).astype(np.int32))
            rare_words = pa.array(list(map(known.words.__getitem__, (keys & 0xFFFFFFFF).tolist())), pa.binary())
            columns = [
                *(batch.column(k) for k in range(3)),
                pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(units)),
                pa.array(np.add.reduceat(n > 0, begins, dtype=np.int64)),
                pa.array(np.add.reduceat(logs, begins)),
                pa.array(np.add.reduceat(np.where(units >= len(facts.units), logs, 0.0), begins)),
                pa.ListArray.from_arrays(bounds, rare_words),
                pa.ListArray.from_arrays(bounds, pa.array(times, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.select(*names[:3], "text").mapInArrow(
        run, f"doc_id {kind.simpleString()}, out boolean, slice int, units array<int>, known long, base double, spelled double, words array<binary>, times array<long>"
    )


def unit_scores(rows: DataFrame, counts: Counts, model: Model) -> DataFrame:
    """``row``, ``n_tokens`` and ``unit_score``: log10 of the units and of their words but for the counts."""
    load = shipped(rows.sparkSession, (counts, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts, lm = load()
        # What a word's unit adds to each of its words: nothing for units of one word.
        within = -np.log10(facts.unit_total + facts.unit_distinct + 1.0)
        within[: len(facts.units)] = 0
        for batch, units, ends in _unit_rows(batches, 1):
            contexts = contexts_of(units, ends, len(lm.target), len(lm.weights))
            logs = lm.logs(contexts, units) / np.log(10) + within[units]
            begins = np.r_[0, ends[:-1]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ends - begins, pa.int64()), pa.array(np.add.reduceat(logs, begins))], ["row", "n_tokens", "unit_score"])

    return rows.select("row", "units").mapInArrow(run, "row long, n_tokens long, unit_score double")


def scored(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, word numbers, ``base_score`` and ``score`` (log10) of every row.

    The base is the smoothed unigram over training words. Null and empty texts hold the end
    only. Null ids count as the empty text when rows are held out; repeated ids and rows stay
    and count each. Without training rows every probability is that of an unknown word or unit.
    Texts of any length are scored whole. Words of one count tie by their bytes. An empty table
    gives an empty result. Only ``doc_id`` and ``text`` are read, so names of other columns
    cannot clash. The training of a task depends on the rows it gets, so scores of tables split
    in another way differ a little.
    """
    text = F.coalesce("text", F.lit(""))
    turn = F.pmod(F.xxhash64("doc_id", text), F.lit(sum(r for r, _ in ROUNDS))).cast("int")
    rows = documents.select("doc_id", text.alias("text"), held_out(F.col("doc_id")).alias("out"), turn.alias("slice"))
    table = written(word_counts(rows))
    counts = gathered(table)
    found = written(in_units(rows, counts).withColumn("row", F.monotonically_increasing_id()))
    own = unit_scores(found, counts, trained(found, counts))
    # None of these words is a hot key: each makes up less than 1 / HEAD of all words.
    rare = found.select("row", F.inline(F.arrays_zip("words", "times"))).withColumnRenamed("words", "word")
    # Counts are spread evenly over their words: a partition of them fits a hash table.
    joined = rare.join(table.where("n > 0").select("word", "n").hint("shuffle_hash"), "word")
    # Words without a training count add log10(1).
    sums = joined.groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + F.lit(1.0))).alias("rare"))
    whole = found.select("row", "doc_id", "out", "known", "base", "spelled").join(own, "row").join(sums, "row", "left")
    extra = F.coalesce("rare", F.lit(0.0))
    return whole.select(
        "doc_id",
        F.col("out").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(counts.total).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * float(np.log10(counts.total + counts.distinct + 1))).alias("base_score"),
        (F.col("unit_score") + F.col("spelled") + extra).alias("score"),
    )
