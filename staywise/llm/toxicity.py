"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other. The model of a category sees the text
features and the probabilities of all earlier categories; in training those come from
models that were fitted without the document's fold, so that the later model learns from
probabilities as unsure as the ones it will meet.

Features are hashed indicators: whole words, word beginnings of four to six bytes (they carry
a stem over its inflections) and word endings. Per category the features whose
smoothed log odds differ from zero by ``SELECT_Z`` standard errors enter a logistic
regression with a ridge penalty.

The classifiers are fitted on at most ``SAMPLE_ROWS`` labelled documents, chosen by a hash of
the id; exact copies count once. Every document is scored on its whole text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.functions.shipping import shipped

from .common import WordIds, byte_strings, id_sets, labelled_sample

#: Bound on the labelled documents a chain is fitted on.
SAMPLE_ROWS = 8_000
BUCKETS = 1 << 18
SELECT_Z = 3.5
RIDGE = 0.2
FOLDS = 3
THRESHOLD = 0.2
#: Categories in the order of the chain, and how they read from the label table.
CATEGORIES = ("poor", "toxic")
WIDTH = 5


_MARKS = b".,;:!?\"'()"


def word_ids(word: bytes) -> tuple[int, ...]:
    """Ids of a word, its first four, five and six bytes, and its last three."""
    bare = word.strip(_MARKS)
    return zlib.crc32(bare), zlib.crc32(bare[:4], 1), zlib.crc32(bare[:5], 2), zlib.crc32(bare[:6], 3), zlib.crc32(word[-3:], 4)


def indicators(text: bytes | None, ids: WordIds, among: np.ndarray | None = None) -> np.ndarray:
    """Distinct feature ids of a lower-cased text, sorted; ``among`` marks the ids that matter."""
    found = text.decode("utf-8", "replace").lower().encode().split() if text else []
    if not found:
        return np.zeros(0, np.int64)
    every = ids.rows(found).ravel() % BUCKETS
    return np.unique(every if among is None else every[among[every]])


@dataclass
class Linear:
    """Weights of selected features, of earlier categories' log odds, and a constant."""

    features: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    constant: float


@dataclass
class Matrix:
    """Sets of feature ids, one after the other; ``starts`` says where each begins."""

    ids: np.ndarray
    starts: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.starts) - 1

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows, dtype=np.int32), np.diff(self.starts))

    def restricted(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and column of each entry among ``features`` (sorted)."""
        if not len(features):
            return np.zeros(0, np.int32), np.zeros(0, np.int32)
        place = np.full(BUCKETS, -1, np.int32)
        place[features] = np.arange(len(features), dtype=np.int32)
        at = place[self.ids]
        hit = at >= 0
        return self.owner()[hit], at[hit]

    def take(self, rows: np.ndarray) -> Matrix:
        return stack([self.ids[self.starts[i] : self.starts[i + 1]] for i in rows])


def stack(sets: list[np.ndarray]) -> Matrix:
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int64)
    return Matrix(np.concatenate(sets).astype(np.int32, copy=False) if sets else np.zeros(0, np.int32), starts)


def log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def selected(on: np.ndarray, all_: np.ndarray, n1: float, n: float) -> np.ndarray:
    """Features tied to a category, sorted; ``on`` of their ``all_`` rows are among its n1 of n."""
    if not 0 < n1 < n:
        return np.zeros(0, np.int64)
    off = all_ - on
    a, b, c, d = on + 0.5, n1 - on + 0.5, off + 0.5, n - n1 - off + 0.5
    z = np.log(a * d / (b * c)) / np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    return np.flatnonzero(np.abs(z) >= SELECT_Z)


def fit_linear(x: Matrix, y: np.ndarray, earlier: np.ndarray, features: np.ndarray, steps: int = 100) -> Linear:
    """Ridge logistic regression on some features by accelerated gradient steps of a safe length.

    With a single class present the model is the constant log odds of that class, smoothed.
    """
    share = (y.sum() + 0.5) / (len(y) + 1)
    width = earlier.shape[1]
    if not 0 < y.sum() < len(y):
        return Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(width), float(log_odds(np.array([share]))[0]))
    row, col = x.restricted(features)
    # Columns are scaled so that one step length suits all of them.
    counts = np.bincount(col, minlength=len(features)) + 1.0
    dense = np.concatenate([earlier / 4, np.ones((len(y), 1))], axis=1)
    most = max(1, np.bincount(row, minlength=len(y)).max(initial=0))
    scale = np.concatenate([1 / np.sqrt(counts * most), np.full(width + 1, 1 / np.sqrt(len(y) * (width + 1) * 4))])
    theta = np.zeros(len(scale))
    ahead, momentum = theta.copy(), 1.0
    for _ in range(steps):
        w = ahead * scale
        score = np.bincount(row, weights=w[col], minlength=len(y)) + dense @ w[len(features) :]
        wrong = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - y
        grad = np.concatenate([np.bincount(col, weights=wrong[row], minlength=len(features)) + RIDGE * w[: len(features)], dense.T @ wrong]) * scale
        new = ahead - grad
        later = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead, theta, momentum = new + (momentum - 1) / later * (new - theta), new, later
    w = theta * scale
    return Linear(features, w[: len(features)], w[len(features) : -1] / 4, float(w[-1]))


def predict_linear(model: Linear, x: Matrix, earlier: np.ndarray) -> np.ndarray:
    row, col = x.restricted(model.features)
    score = np.bincount(row, weights=model.weights[col], minlength=x.rows) + earlier @ model.earlier + model.constant
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def fit_chain(sets: list[np.ndarray], labels: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """A model per column of ``labels``, each fed with the earlier ones' out-of-fold results.

    ``sets``: the feature ids of each row. Only selected features are laid out as a matrix, so
    memory is little more than the sets.
    """
    chain, earlier, n = [], np.zeros((len(sets), 0)), len(sets)
    parts = np.unique(folds)
    rows_of = {f: np.flatnonzero(folds == f) for f in parts}
    all_ = {f: np.zeros(BUCKETS) for f in parts}
    for found, fold in zip(sets, folds, strict=True):
        all_[fold][found] += 1
    every = sum(all_.values()) if n else np.zeros(BUCKETS)
    for k in range(labels.shape[1]):
        y = labels[:, k].astype(float)
        on = {f: np.zeros(BUCKETS) for f in parts}
        for i in np.flatnonzero(y):
            on[folds[i]][sets[i]] += 1
        whole = sum(on.values()) if n else np.zeros(BUCKETS)
        chosen = {None: selected(whole, every, y.sum(), n)}
        for f in parts:
            chosen[f] = selected(whole - on[f], every - all_[f], y.sum() - y[rows_of[f]].sum(), n - len(rows_of[f]))
        among = np.zeros(BUCKETS, bool)
        for features in chosen.values():
            among[features] = True
        x = stack([found[among[found]] for found in sets])
        chain.append(fit_linear(x, y, earlier, chosen[None]))
        unseen = np.zeros(n)
        for f in parts:
            inside, outside = np.flatnonzero(folds != f), rows_of[f]
            model = fit_linear(x.take(inside), y[inside], earlier[inside], chosen[f])
            unseen[outside] = predict_linear(model, x.take(outside), earlier[outside])
        earlier = np.concatenate([earlier, log_odds(unseen)[:, None]], axis=1)
    return chain


def predict_chain(chain: list[Linear], x: Matrix) -> np.ndarray:
    """Probabilities, a column per category."""
    earlier, out = np.zeros((x.rows, 0)), []
    for model in chain:
        out.append(predict_linear(model, x, earlier))
        earlier = np.concatenate([earlier, log_odds(out[-1])[:, None]], axis=1)
    return np.stack(out, axis=1) if out else np.zeros((x.rows, 0))


def train(documents: DataFrame, labels: DataFrame, categories: tuple[str, ...], sample_rows: int = SAMPLE_ROWS) -> list[Linear]:
    """Fit a chain; ``labels`` holds doc_id and a 0/1 column per category.

    No labelled document at all gives a chain that answers 0.5 to everything.
    """
    sample = labelled_sample(documents, labels, list(categories), sample_rows)
    names = [f"label_{c}" for c in categories]
    kept = sample.select(F.xxhash64("text").alias("h"), "text", *[F.col(c).cast("long").alias(c) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(word_ids, WIDTH)
        for batch in batches:
            sets = [indicators(t, ids).astype(np.int32).tobytes() for t in byte_strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary()), *batch.columns[2:]], ["h", "ids", *names])

    features = kept.mapInArrow(run, ", ".join(["h long", "ids binary", *[f"{c} long" for c in names]]))
    # At most sample_rows rows come to the driver; a text met several times counts once.
    found = features.groupBy("h").agg(F.min("ids").alias("ids"), *[F.max(c).alias(c) for c in names]).toArrow()
    order = np.argsort(found.column("h").to_numpy(), kind="stable")
    sets = id_sets(found.column("ids"))
    y = np.stack([found.column(c).to_numpy() for c in names], axis=1)
    return fit_chain([sets[i] for i in order], y[order], found.column("h").to_numpy()[order] % FOLDS)


def scored(documents: DataFrame, chain: list[Linear], categories: tuple[str, ...]) -> DataFrame:
    """All columns of ``documents`` and one probability ``p_<category>`` per category.

    Null and empty texts have no features, so they get the chain's constants. Columns of
    the same names are replaced. Repeated rows are scored alike.
    """
    names = [f"p_{c}" for c in categories]
    load = shipped(documents.sparkSession, chain)  # bounded by BUCKETS per category
    kept = documents.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, model = WordIds(word_ids, WIDTH), load()
        among = np.zeros(BUCKETS, bool)
        for link in model:
            among[link.features] = True
        for batch in batches:
            place = batch.schema.get_field_index("text")
            p = predict_chain(model, stack([indicators(t, ids, among) for t in byte_strings(batch.column(place))]))
            columns = [*batch.columns, *[pa.array(p[:, k]) for k in range(len(names))]]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *names])

    schema = ", ".join([*[f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in kept.schema], *[f"`{n}` double" for n in names]])
    return kept.mapInArrow(run, schema)


def chain_labels(labels: DataFrame) -> DataFrame:
    """The chain's categories from the columns quality and toxic: ``poor`` is quality 0."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("poor"), "toxic")


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``documents``, ``p_poor``, ``p_toxic`` and ``is_toxic``."""
    kept = chain_labels(labels)
    chain = train(documents, kept, CATEGORIES)
    return scored(documents, chain, CATEGORIES).withColumn("is_toxic", F.col("p_toxic") >= threshold)
