"""Language identification by multilingual mixtures.

A text is taken as a bag of character trigrams drawn from a mixture of languages. Each
language has a smoothed trigram distribution, counted over all training texts. For a text,
expectation-maximisation finds the proportions of a set of languages; sets grow by the
language that explains the text best, and a language enters only if it raises the log
likelihood by more than a penalty that grows with the logarithm of the text's length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staywise.functions.shipping import shipped

UNDETERMINED = "und"
BUCKETS = 1 << 15
#: Added to each trigram's count, as a share of a language's trigrams.
SMOOTHING = 0.5
#: Log likelihood that each further language must bring, times log(1 + trigrams).
PENALTY = 3.0
STEPS = 25
#: Languages that a training task counts at once; more are handed on in between.
HELD = 32

#: Which characters of the basic plane are letters.
_LETTERS = None


def _letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x10000)), bool, 0x10000)
    return _LETTERS


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the trigrams of a lower-cased text; runs of other signs count as one space.

    Empty for a text without letters.
    """
    if not text:
        return np.zeros(0, np.int64)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[np.minimum(codes, 0xFFFF)]
    high = np.flatnonzero(codes > 0xFFFF)
    if len(high):
        letter[high] = [chr(c).isalpha() for c in codes[high]]
    if not letter.any():
        return np.zeros(0, np.int64)
    codes = np.where(letter, codes, 32)
    codes = codes[letter | np.concatenate([[True], letter[:-1]])]
    codes = np.concatenate([[32], codes, [32]])
    if codes[1] == 32:
        codes = codes[1:]
    if codes[-2] == 32:
        codes = codes[:-1]
    mixed = (codes[:-2] * 0x9E3779B1 + codes[1:-1] * 0x85EBCA77 + codes[2:] * 0xC2B2AE3D) & 0xFFFFFFFF
    return ((mixed ^ (mixed >> 15)) * 0x2C1B3C6D & 0xFFFFFFFF) >> 17


def counted(documents: DataFrame) -> DataFrame:
    """``lang``, ``bucket``, ``n`` over all texts with a language: sums of what each task counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def emptied() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                hit = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hit), pa.string()), pa.array(hit), pa.array(counts[hit])], ["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang not in held and len(held) >= HELD:
                    yield from emptied()
                counts = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                found, n = _unique(trigrams(text))
                counts[found] += n
        yield from emptied()

    kept = documents.where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    return kept.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _unique(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(found, return_counts=True)


@dataclass
class Languages:
    """Names in order, and the probability of each trigram (rows) in each language (columns)."""

    names: list[str]
    p: np.ndarray


def learn(documents: DataFrame) -> Languages:
    """Trigram distributions of all languages met; at most BUCKETS values a language."""
    found = counted(documents).toArrow()
    lang = np.array(found.column("lang").to_pylist(), object)
    names = sorted(set(lang))
    counts = np.zeros((BUCKETS, len(names)))
    place = {n: k for k, n in enumerate(names)}
    counts[found.column("bucket").to_numpy(), [place[n] for n in lang]] = found.column("n").to_numpy()
    counts += SMOOTHING
    return Languages(names, counts / counts.sum(axis=0))


def proportions(p: np.ndarray, n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, float]:
    """Mixture proportions by expectation-maximisation, and their log likelihood."""
    share, total, before = start, n.sum(), -np.inf
    for _ in range(STEPS):
        mix = p @ share
        likely = float(n @ np.log(mix))
        if likely - before < 1e-3:
            break
        before = likely
        share = share * ((n / mix) @ p) / total
    return share, likely


def identify(model: Languages, text: str | None) -> tuple[str, float, list[tuple[str, float]]]:
    """The language with the largest proportion, that proportion, and the whole set."""
    found, n = _unique(trigrams(text))
    if not len(found) or not model.names:
        return UNDETERMINED, 0.0, []
    p, n = model.p[found], n.astype(float)
    alone = n @ np.log(p)
    chosen = [int(np.argmax(alone))]
    share, likely = np.ones(1), float(alone[chosen[0]])
    price = PENALTY * np.log1p(n.sum())
    while len(chosen) < len(model.names):
        # The gain that a little of each other language would bring says which to try.
        mix = p[:, chosen] @ share
        gain = (n / mix) @ p - n.sum()
        gain[chosen] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= 0:
            break
        wider = [*chosen, best]
        new, better = proportions(p[:, wider], n, np.append(share * 0.9, 0.1))
        if better - likely <= price:
            break
        chosen, share, likely = wider, new, better
    top = int(np.argmax(share))
    parts = sorted(((model.names[k], float(s)) for k, s in zip(chosen, share, strict=True)), key=lambda x: (-x[1], x[0]))
    return model.names[chosen[top]], min(1.0, float(share[top])), parts


def identified(documents: DataFrame, model: Languages) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``languages`` ("en:0.900,de:0.100"), a row per document.

    ``score`` is the proportion of the language named. Null texts and texts without letters
    are ``und`` with score 0, as is every text if nothing was learned. Ties go to the
    language that comes first by code point.
    """
    load = shipped(documents.sparkSession, model)  # BUCKETS values a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = load()
        for batch in batches:
            found = [identify(known, t) for at in range(0, batch.num_rows, 512) for t in batch.column(1).slice(at, 512).to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([",".join(f"{a}:{s:.3f}" for a, s in f[2]) for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "lang_pred", "score", "languages"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, languages string")
