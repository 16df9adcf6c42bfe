"""Language-model scores: counts by brute force, normalised probabilities, gain on held-out texts."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from staywise.llm import scoring

KINDS = "doc_id long, text string, n int, words string, units long"


def documents(spark, rows):
    """Rows (doc_id, text); further columns clash with names used inside the operator."""
    return spark.createDataFrame([(i, t, 1, "w", 2) for i, t in rows], KINDS)


def held(doc_id) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def words(text):
    return [*(text or "").encode().lower().split(), b"\n"]


def counted(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) of all rows, sorted."""
    train = Counter(w for i, t in rows if not held(i) for w in words(t))
    total = sum(train.values())
    base = lambda t: sum(math.log10((train[w] + 1) / (total + len(train) + 1)) for w in words(t))
    return sorted((str(i), held(i), len(words(t)), sum(train[w] > 0 for w in words(t)), total, round(base(t), 6)) for i, t in rows)


def seen(found):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)


ODD = [(1, "a b a"), (2, None), (2, ""), (None, "X y"), (None, None), (3, " \n"), (3, " \n"), (16, "unseen words here"), (9, "É é A a " + "w " * 30_000), (5, "x y z \x1c q")]


def prose(seed: int, n: int) -> str:
    """Two made-up languages; the words of a text are all of one."""
    rng = random.Random(seed)
    parts = (("ba", "ko", "ri"), ("zen", "mar", "quer"))[seed % 2]
    return " ".join("".join(rng.choices(parts, k=rng.choice((1, 2, 3)))) for _ in range(n))


def test_counts_by_brute_force(spark):
    rows = ODD + [(100 + k, prose(k, 50)) for k in range(60)]
    found = scoring.scored(documents(spark, rows)).collect()
    assert seen(found) == counted(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)


def test_frequent_and_rare_words_are_counted_alike(spark, monkeypatch):
    """With a head of few words nearly all counts come by the join."""
    rows = ODD + [(100 + k, prose(k, 50)) for k in range(60)]
    whole = {(r.doc_id, round(r.base_score, 6)): r.score for r in scoring.scored(documents(spark, rows)).collect()}
    monkeypatch.setattr(scoring, "HEAD", 4)
    found = scoring.scored(documents(spark, rows)).collect()
    assert seen(found) == counted(rows)
    assert all(whole[r.doc_id, round(r.base_score, 6)] == pytest.approx(r.score, abs=1e-6) for r in found)


def made(texts):
    train = Counter(w for t in texts for w in words(t))
    units = {w: k for k, w in enumerate([b"\n", *[w for w, _ in train.most_common(4) if w != b"\n"]])}
    facts = scoring.Counts(sum(train.values()), len(train), {}, units, np.zeros(len(units) + 8, np.int64), np.zeros(len(units) + 8, np.int64), 8)
    for w, n in train.items():
        facts.unit_total[facts.unit(w)] += n
        facts.unit_distinct[facts.unit(w)] += 1
    return train, facts


def units_of(facts, lists):
    known = scoring.Lookup(facts)
    at, ends = known.places(lists)
    return known.units[at], ends


def test_remembered_words_are_bounded():
    _, facts = made([prose(k, 80) for k in range(30)])
    small, large = scoring.Lookup(facts, 40), scoring.Lookup(facts)
    for k in range(30):
        lists = [words(prose(k, 30)), words(None)]
        (a, _), (b, _) = small.places(lists), large.places(lists)
        assert [small.words[i] for i in a] == [large.words[i] for i in b] and small.units[a].tolist() == large.units[b].tolist()
        assert len(small.place) <= 40


def test_probabilities_add_up_to_one():
    train, facts = made([prose(k, 80) for k in range(30)])
    trainer = scoring.Trainer(scoring.started(facts), scoring.noise_of(facts), 1)
    found, ends = units_of(facts, [words(prose(k, 80)) for k in range(30)])
    contexts = scoring.contexts_of(found, ends, len(trainer.model.target), scoring.CONTEXT)
    trainer.text(contexts, found, 64)
    for context in contexts[::400]:
        units = np.arange(len(facts.unit_total))
        p = np.exp(trainer.model.logs(np.tile(context, (len(units), 1)), units))
        assert p.sum() == pytest.approx(1, abs=1e-5)
    share = Counter()
    for w, n in train.items():
        k = facts.unit(w)
        share[k] += 1.0 if k < len(facts.units) else (n + 1) / (facts.unit_total[k] + facts.unit_distinct[k] + 1)
    for k, total in share.items():  # what is missing is the share of one unknown word
        rest = 0 if k < len(facts.units) else 1 / (facts.unit_total[k] + facts.unit_distinct[k] + 1)
        assert total + rest == pytest.approx(1)


def test_slopes_by_differences():
    """The batch's step follows the slope of the contrastive loss."""
    _, facts = made([prose(k, 20) for k in range(6)])
    noise = scoring.noise_of(facts)
    found, ends = units_of(facts, [words(prose(3, 40))])
    begun = scoring.started(facts)
    contexts = scoring.contexts_of(found, ends, len(begun.target), scoring.CONTEXT)
    trainer = scoring.Trainer(begun, noise, 5, drawn=6)
    slopes = {}
    trainer._move = lambda part, slope, at=slice(None): slopes.__setitem__(part, (at, slope))
    trainer.batch(contexts, found)
    again = np.random.default_rng(5)
    drawn = np.minimum(np.searchsorted(np.cumsum(noise), again.random(6)), len(noise) - 1)

    def loss(model):
        mixed = sum(model.context[contexts[:, k]].astype(float) * model.weights[k] for k in range(scoring.CONTEXT))
        score = mixed @ model.target.T.astype(float) + model.bias - np.log(6 * noise)
        own = score[np.arange(len(found)), found]
        return (np.log1p(np.exp(-own)) + np.log1p(np.exp(score[:, drawn])).sum(axis=1)).mean()

    for part in range(4):
        at, slope = slopes[part]
        full = np.zeros_like(begun.parts()[part], float)
        full[at] = slope
        rng = np.random.default_rng(part)
        for _ in range(3):
            way = rng.standard_normal(full.shape)
            moved = []
            for sign in (1, -1):
                parts = [p.astype(float).copy() for p in begun.parts()]
                parts[part] = parts[part] + sign * 1e-4 * way
                moved.append(loss(scoring.Model(*parts)))
            assert (moved[0] - moved[1]) / 2e-4 == pytest.approx((full * way).sum(), rel=1e-3, abs=1e-5)


def test_contexts_do_not_cross_texts():
    got = scoring.contexts_of(np.array([4, 5, 6, 7, 8]), np.array([3, 5]), 99, 3)
    assert got.tolist() == [[99, 99, 99], [4, 99, 99], [5, 4, 99], [99, 99, 99], [7, 99, 99]]


def test_held_out_texts_gain(spark):
    rows = [(k, prose(k, 150)) for k in range(700)]
    found = [r for r in scoring.scored(documents(spark, rows)).collect() if r.held_out]
    assert len(found) > 50
    assert sum(r.score for r in found) > 0.95 * sum(r.base_score for r in found)


def test_average_of_models_by_tree(spark, monkeypatch):
    monkeypatch.setattr(scoring, "FAN", 3)
    rng = np.random.default_rng(1)
    models, n = rng.standard_normal((20, 5)), rng.integers(1, 9, 20)
    copies = spark.createDataFrame([(k, int(n[k]), bytearray(models[k].tobytes())) for k in range(20) if k != 7], "part long, n long, model binary")
    keep = np.arange(20) != 7
    assert np.allclose(scoring._averaged(copies), np.average(models[keep], axis=0, weights=n[keep]))
    assert scoring._averaged(copies.limit(0)) is None


def test_empty_and_untrained(spark):
    assert scoring.scored(documents(spark, [])).collect() == []
    out = next(i for i in range(100) if held(i))
    (row,) = scoring.scored(documents(spark, [(out, "one two")])).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0) and row.score < 0
