"""Quality classifier: naive Bayes support vectors.

Hashed n-gram indicators are scaled by the log ratio of their shares in the two classes;
on the scaled rows (of unit length) a linear model with hinge loss is fitted by dual
coordinate descent. Margins turn into probabilities by a logistic curve that is fitted on
out-of-fold margins.

N-grams: words and pairs of words, and over the words' shapes (which signs, capitals, digits
and marks at the ends) single shapes, pairs and triples; a word or a line that repeats what
stands before it is an n-gram of its own.

The model is fitted on at most ``SAMPLE_ROWS`` labelled documents, chosen by a hash of the id;
exact copies count once. Every document is scored on its whole text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.functions.shipping import shipped

from .common import WordIds, byte_strings, id_sets, labelled_sample

SAMPLE_ROWS = 8_000
BUCKETS = 1 << 18
SMOOTHING = 1.0
COST = 1.0
ROUNDS = 12
FOLDS = 3
THRESHOLD = 0.3
WIDTH = 3
#: Ids of the n-grams "same word again" and "same line again".
REPEATED_WORD, REPEATED_LINE = 1, 2

#: Letters to ``a`` (small, or beyond ASCII) and ``A``, digits to ``0``; marks stay.
_KINDS = bytes(97 if chr(c).islower() or c > 127 else 65 if chr(c).isupper() else 48 if chr(c).isdigit() else c for c in range(256))
_AGAIN = re.compile(rb"(.)\1+")


def shape(word: bytes) -> bytes:
    """A word with runs of a kind of sign reduced to one, e.g. ``Aa,`` or ``A!``."""
    return _AGAIN.sub(rb"\1", word.translate(_KINDS))[:12]


def word_ids(word: bytes) -> tuple[int, ...]:
    return zlib.crc32(word), zlib.crc32(shape(word), 1), zlib.crc32(word[-2:], 2)


def indicators(text: bytes | None, ids: WordIds) -> np.ndarray:
    """Distinct n-gram ids of a text, sorted."""
    found = text.split() if text else []
    if not found:
        return np.zeros(0, np.int32)
    word, form, end = np.ascontiguousarray(ids.rows(found).T)
    pair = (word[:-1] * 0x9E3779B1 + word[1:] * 0x85EBCA77 + 17) % 0xFFFFFFFB
    form2 = (form[:-1] * 0x9E3779B1 + form[1:] * 0x85EBCA77 + 29) % 0xFFFFFFFB
    form3 = (form2[:-1] * 0x9E3779B1 + form[2:] + 31) % 0xFFFFFFFB if len(form) > 2 else form2[:0]
    parts = [word, form, end, pair, form2, form3]
    if (word[:-1] == word[1:]).any():
        parts.append(np.array([REPEATED_WORD]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    if len(set(lines)) < len(lines):
        parts.append(np.array([REPEATED_LINE]))
    return np.unique(np.concatenate(parts) % BUCKETS).astype(np.int32)


@dataclass
class Model:
    """Weights per bucket (of the scaled indicators), a constant, and the logistic curve."""

    ratio: np.ndarray
    weights: np.ndarray
    constant: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        x = self.ratio[found]
        length = np.sqrt(x @ x)
        return float(x @ self.weights[found] / length) + self.constant if length else self.constant

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -30, 30))))


def count_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log of the n-grams' shares in class 1 over those in class 0, smoothed."""
    on, off = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    for found, label in zip(rows, y, strict=True):
        (on if label else off)[found] += 1
    return np.log(on / on.sum()) - np.log(off / off.sum())


def dual_descent(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights and constant of min |w|^2 / 2 + sum cost max(0, 1 - y w x), one dual variable at a time.

    Costs balance the classes. Rows whose variable rests at a bound with the right slope are
    passed over, rounds end early when no variable moves.
    """
    sign = np.where(y > 0, 1.0, -1.0)
    share = max(1, int((y > 0).sum())), max(1, int((y <= 0).sum()))
    cost = np.where(y > 0, len(y) / (2 * share[0]), len(y) / (2 * share[1])) * COST
    scale = np.array([1 / max(1e-12, float(np.linalg.norm(ratio[found]))) for found in rows])
    square = np.array([2.0 if len(found) else 1.0 for found in rows])  # the constant is a feature of value 1
    w, constant, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(ROUNDS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            found = rows[i]
            x = ratio[found] * scale[i]
            slope = sign[i] * (w[found] @ x + constant) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost[i])
            step = new - alpha[i]
            if abs(step) > 1e-9:
                alpha[i] = new
                w[found] += step * sign[i] * x
                constant += step * sign[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, constant


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through margins, with smoothed labels, by Newton steps."""
    n1, n0 = (y > 0).sum(), (y <= 0).sum()
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (p - goal) + 1e-6 * theta
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta -= step * min(1.0, 2 / (1e-9 + np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return float(max(theta[0], 1e-6)), float(theta[1])


def fit(rows: list[np.ndarray], y: np.ndarray, folds: np.ndarray) -> Model:
    """A model; without rows of both classes its score is the smoothed share of class 1."""
    empty = np.zeros(BUCKETS)
    if len(set((y > 0).tolist())) < 2:
        share = ((y > 0).sum() + 1) / (len(y) + 2)
        return Model(empty, empty, 0.0, 1.0, float(np.log(share / (1 - share))))

    def part(chosen: np.ndarray) -> Model:
        some = [rows[i] for i in chosen]
        ratio = count_ratios(some, y[chosen])
        return Model(ratio, *dual_descent(some, y[chosen], ratio), 1.0, 0.0)

    margin = np.zeros(len(rows))
    for fold in np.unique(folds):
        inside, outside = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
        model = part(inside)
        margin[outside] = [model.margin(rows[i]) for i in outside]
    model = part(np.arange(len(rows)))
    model.slope, model.shift = logistic_curve(margin, y)
    return model


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample of the labelled documents."""
    sample = labelled_sample(documents, labels, [label], sample_rows)
    kept = sample.select(F.xxhash64("text").alias("h"), "text", F.col(f"label_{label}").cast("long").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds(word_ids, WIDTH)
        for batch in batches:
            sets = [indicators(t, ids).tobytes() for t in byte_strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary()), batch.column(2)], ["h", "ids", "y"])

    # At most sample_rows rows come to the driver; a text met several times counts once.
    found = kept.mapInArrow(run, "h long, ids binary, y long").groupBy("h").agg(F.min("ids").alias("ids"), F.max("y").alias("y")).toArrow()
    order = np.argsort(found.column("h").to_numpy(), kind="stable")
    sets = id_sets(found.column("ids"))
    rows = [sets[i] for i in order]
    return fit(rows, found.column("y").to_numpy()[order], found.column("h").to_numpy()[order] % FOLDS)


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1, higher: class 1 is likelier), a row per document.

    Null and empty texts have no n-grams and get the score of the constant alone. Repeated
    rows are scored alike; extra columns are ignored.
    """
    load = shipped(documents.sparkSession, model)  # 2 * BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, fitted = WordIds(word_ids, WIDTH), load()
        for batch in batches:
            scores = [fitted.score(indicators(t, ids)) for t in byte_strings(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
