"""The operators on small tables: brute force, and nulls, empty texts, ties, repeats, extra columns."""

import itertools
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from staywise.llm import components, decontaminate, forest, hilbert, html, language, mixing, quality, simhash, tokens, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _start string, shards string"
VOCABULARY = [a + b for a in ("ba", "ko", "ri", "tu", "zen", "mar") for b in ("lo", "ti", "na", "quer", "is")]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def documents(spark, rows):
    """Rows (doc_id, text, source); further columns clash with names used inside the operators."""
    return spark.createDataFrame([(i, t, "en" if i is None or i % 2 else None, s, None, "x", "y") for i, t, s in rows], DOCS)


ODD = [
    (1, prose(1, 40), "a"), (2, prose(1, 40), "a"), (2, prose(1, 40), "a"), (None, prose(1, 40), None), (None, None, None), (3, None, "b"), (4, "", "b"), (5, "   \n\t", "b"),
    (6, "x", "c"), (7, "x", "c"), (8, prose(2, 6000), "c"), (9, "é" * 3000, "a"), (10, "two words", None), (10, "other text", "b"), (11, "!!! ???", "a"),
]


def test_mixture_by_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, prose(i, rng.choice([0, 1, 5, 80, 300])), rng.choice(["s1", "s2", "s3", "s4", None])) for i in range(300)]
    out = [r.asDict() for r in mixing.mixture(documents(spark, rows)).collect()]
    assert len(out) == 300
    assert {r["doc_id"]: r["size"] for r in out} == {i: len(t.split()) for i, t, _ in rows}
    size, taken, target = {}, {}, {}
    for r in out:
        size[r["source"]] = size.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert {r["source"]: r["source_size"] for r in out} == size
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    open_, left, expected = set(size), float(sum(size.values())), {}
    while True:  # reshare until no source is above its limit
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 3 * size[s]}
        if not over:
            expected |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            expected[s] = 3.0 * size[s]
            left -= expected[s]
        open_ -= over
    for s in size:
        assert target[s] == pytest.approx(expected[s])
        assert abs(taken[s] - target[s]) <= 2
    again = mixing.mixture(documents(spark, rows).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r["doc_id"], r["taken"]) for r in out)


def test_apportionment_takes_highest_quotients(spark):
    rng = random.Random(5)
    for seats in (0, 1, 7, 50, 333):
        weights = [rng.choice([0, 1, 3, 10, 100, 100, 1000]) for _ in range(9)]
        frame = spark.createDataFrame([(g, i, float(w), seats) for g in ("p", None) for i, w in enumerate(weights)], "g string, m int, w double, seats long")
        got = {(r.g, r.m): r.quota for r in mixing.apportion(frame, ["g"], "m", "w", "seats").collect()}
        quotients = sorted(((-w / (2 * k + 1), i) for i, w in enumerate(weights) if w for k in range(seats)))[:seats]
        expected = [sum(1 for _, i in quotients if i == m) for m in range(9)]
        for g in ("p", None):
            assert [got[g, m] for m in range(9)] == expected


def test_mixture_on_odd_rows(spark):
    out = mixing.mixture(documents(spark, ODD)).collect()
    assert len(out) == len(ODD) and all(r.taken <= 3 * r.size for r in out)
    whole = mixing.mixed(documents(spark, ODD))
    assert whole.columns == documents(spark, []).columns
    assert all(r.text and r.text.split() for r in whole.collect())
    assert mixing.mixture(documents(spark, [])).count() == 0
    assert mixing.mixed(documents(spark, [])).count() == 0


def slow_fingerprint(text):
    found = (text or "").encode().lower().split()
    parts = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    votes = [sum(xxhash.xxh64_intdigest(p, 42) >> b & 1 for p in parts) for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(parts))


def test_near_duplicates_on_odd_rows(spark):
    rows = [*ODD, *[(100 + i, " ".join(prose(7, 400).split()[: 400 - i % 3]), "z") for i in range(20)]]
    out = simhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted((str(i), format(slow_fingerprint(t), "016x")) for i, t, _ in rows) == sorted((str(r.doc_id), r.fingerprint) for r in out)
    prints = {int(r.fingerprint, 16) for r in out}
    group = {p: {p} for p in prints}
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 2 and group[a] is not group[b]:
            joined = group[a] | group[b]
            for p in joined:
                group[p] = joined
    for r in out:
        same = group[int(r.fingerprint, 16)]
        ids = [q.doc_id for q in out if int(q.fingerprint, 16) in same and q.doc_id is not None]
        assert r.component_id == min(ids, default=None)
    kept = simhash.one_of_each(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted({r.component_id for r in out})
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("crowd", [2048, 3])
def test_links_lose_nothing(spark, monkeypatch, crowd):
    """Both paths of a key, also for keys that many fingerprints share."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = random.Random(9)
    prints = {0}
    for _ in range(40):
        x = rng.getrandbits(64)
        prints |= {x} | {x ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(rng.randrange(6))} | {x & 0xFFFFFFFF}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    nodes = components.components(simhash.links(spark.createDataFrame(signed, "fp long")))
    root = {r.node: r.root for r in nodes.collect()}
    parent = {p: p for (p,) in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a,), (b,) in itertools.combinations(signed, 2):
        if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
            parent[find(a)] = find(b)
    classes = {}
    for (p,) in signed:
        classes.setdefault(find(p), []).append(p)
    for members in classes.values():
        assert {root.get(p, p) for p in members} == {min(members)}


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    fps = rng.integers(0, 2**63, 200).astype(np.uint64)
    fps[100:] = fps[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    planes = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T.copy()
    left, right = (a.ravel() for a in np.meshgrid(np.arange(200), np.arange(200)))
    assert (simhash.near(planes, left, right) == (np.bitwise_count(fps[left] ^ fps[right]) <= 2)).all()
    assert (simhash.near(planes, left, right, 1) == (np.bitwise_count(fps[left] ^ fps[right]) <= 1)).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 200), (7, 7)], "a long, b long")
    root = {r.node: r.root for r in components.components(edges).collect()}
    assert root == {i: 0 for i in range(61)} | {100: 100, 200: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_leaks_survive_substitutions(spark):
    items = [prose(50 + i, n) for i, n in enumerate((60, 30, 12, 7, 5, 3))]
    bench = spark.createDataFrame([*enumerate(items), (90, items[0]), (91, None), (92, "")], "item_id long, text string")

    def changed(text, every):
        return " ".join("swapped" if i % every == every - 1 else w for i, w in enumerate(text.split()))

    rows = [(i, prose(70 + i, 50) + " " + t + " " + prose(80 + i, 50), "s") for i, t in enumerate(items)]
    rows += [(10, prose(90, 30) + " " + changed(items[0], 6), "s"), (11, changed(items[1], 5).upper().replace(" ", ", "), "s"), (12, prose(91, 500), "s"), (13, " ".join(items[0].split()[20:40]), "s")]
    found = decontaminate.overlaps(documents(spark, rows + ODD), bench)
    pairs = {(r.doc_id, r.item_id) for r in found.collect()}
    assert pairs == {(0, 0), (0, 90), (1, 1), (2, 2), (3, 3), (4, 4), (10, 0), (10, 90), (11, 1), (13, 0), (13, 90)}
    first = found.where("doc_id = 0 and item_id = 0").first()
    assert (first.equal_words, first.doc_word, first.item_word) == (60, 50, 0)
    kept = decontaminate.decontaminated(documents(spark, rows + ODD), bench)
    assert kept.count() == len(rows) + len(ODD) - 8 and kept.columns == documents(spark, []).columns
    assert decontaminate.overlaps(documents(spark, []), bench).count() == 0
    assert decontaminate.decontaminated(documents(spark, ODD), bench.limit(0)).count() == len(ODD)


def test_leaks_with_a_large_benchmark(spark, monkeypatch):
    """Past the bound of the broadcast the same rows come from joins by shuffle."""
    bench = spark.createDataFrame([(i, prose(50 + i, 20)) for i in range(5)], "item_id long, text string")
    docs = documents(spark, [(i, prose(i, 30) + " " + prose(50 + i % 7, 20), "s") for i in range(30)])
    wanted = sorted(map(tuple, decontaminate.overlaps(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", 0)
    assert sorted(map(tuple, decontaminate.overlaps(docs, bench).collect())) == wanted and len(wanted) >= 20


def walk(bits, dims):
    """Cells in curve order from the index, by brute force over all cells."""
    return list(itertools.product(range(1 << bits), repeat=dims))


@pytest.mark.parametrize("bits", [1, 2, 3])
def test_curve_steps_to_neighbours(spark, bits):
    cells = spark.createDataFrame(walk(bits, 3), "a int, b int, c int")
    order = hilbert.curve_index(cells, ["a", "b", "c"], bits, "at").orderBy("at").collect()
    assert [r["at"] for r in order] == list(range(8**bits))
    assert all(sum(abs(p[k] - q[k]) for k in "abc") == 1 for p, q in zip(order, order[1:], strict=False))


@pytest.mark.parametrize("cell_rows", [50_000, 3])
def test_shards_are_even(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(hilbert, "CELL_ROWS", cell_rows)
    rows = ODD + [(1000 + i, prose(i % 5, i % 40), f"s{i % 3}") for i in range(120)]
    out = hilbert.sharded(documents(spark, rows)).collect()
    assert len(out) == len(rows)
    slots = {s: sorted(r["slot"] for r in out if r["shard"] == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    line = [r["curve"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    assert line == sorted(line)
    again = hilbert.sharded(documents(spark, rows).repartition(5)).collect()
    key = lambda r: (str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"])
    assert sorted(map(key, again)) == sorted(map(key, out))
    assert hilbert.sharded(documents(spark, [])).count() == 0
    assert hilbert.sharded(documents(spark, ODD[:3])).count() == 3


def test_token_counts_equal_the_library(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    texts = ["", None, "a", " a", "Hello<|endoftext|>world <|endoftext|> x", "<|endoftext|>", "  two  spaces\n\n\nlines \t tab ", "it's we'll 'sun's", "naïve café — déjà vu 日本語 ½ ² x² ١٢٣ ՘Ᲊ \U0001f600 é",
             "a​b c　d e", "1234567 3.14", "x" * 5000, "<|endoftext", prose(1, 3000), "࢏ ꟏ \U00040000"]
    rng = random.Random(2)
    texts += ["".join(rng.choice("ab 1'!\n\té日²<|̀ͅ") for _ in range(60)) for _ in range(300)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "again", "s"), (0, "again", "s")]
    out = tokens.token_counts(documents(spark, rows), path).collect()
    expected = sorted((str(i), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == expected
    assert all(r.over_limit == (r.n_tokens > 1024) for r in out)
    assert tokens.token_counts(documents(spark, []), path).count() == 0


def test_nearest_by_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((8, 16))
    x = (centres[rng.integers(0, 8, 900)] + 0.4 * rng.standard_normal((900, 16))).astype(np.float32)
    x[300:400] = x[7]  # a frequent vector
    rows = [(i, [float(v) for v in x[i]], 1) for i in range(900)]
    bad = [(1000, None, 1), (1050, [0.0] * 16, 1), (1100, [float("nan")] * 16, 1), (1150, [1.0] * 15 + [None], 1), (1200, [float("inf")] * 16, 1), (1250, [1.0, 2.0], 1), (None, rows[0][1], 1), rows[50]]
    out = forest.nearest(spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, rank int")).collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = 0
    for q in range(0, 900, 50):
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5] and q not in [r.vec_id for r in mine]
        score = np.round(unit @ unit[q], 12)
        best = sorted((i for i in range(900) if i != q), key=lambda i: (-score[i], i))[:5]
        hits += len({r.vec_id for r in mine} & set(best))
        assert all(r.score == pytest.approx(float(unit[r.vec_id] @ unit[q]), abs=1e-12) for r in mine)
    assert hits >= 0.9 * 5 * 18
    assert [r.vec_id for r in sorted((r for r in out if r.query_id == 350), key=lambda r: r.rank)] == [7, 300, 301, 302, 303]
    few = forest.nearest(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>, l int")).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(0, 1), (0, 2)]
    assert forest.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_forest_recall_when_it_searches_a_part(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((40, 32))[rng.integers(0, 40, 12_000)] + 0.5 * rng.standard_normal((12_000, 32))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = forest.nearest(frame, every=200).collect()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 12_000, 200):
        score = unit @ unit[q]
        score[q] = -2
        hits += len({r.vec_id for r in out if r.query_id == q} & set(np.argsort(-score)[:5]))
    assert hits >= 0.9 * 5 * 60


def test_language_mixture(spark):
    rng = random.Random(8)
    alphabets = {"aa": "abcdefgh", "bb": "opqrstuv", "cc": "abcdopqr"}
    word = lambda lang: "".join(rng.choice(alphabets[lang]) for _ in range(6))
    text = lambda lang, n: " ".join(word(lang) for _ in range(n))
    train = [(i, text(lang, 80), lang) for i, lang in enumerate(list(alphabets) * 10)]
    model = language.learn(spark.createDataFrame([*train, (99, None, "zz"), (98, "x", None)], "doc_id long, text string, lang string"))
    assert model.names == list(alphabets)
    both = text("aa", 100) + " " + text("bb", 50)
    rows = [(i, text(lang, n), lang) for i, (lang, n) in enumerate(itertools.product(alphabets, (5, 30, 200)))]
    rows += [(50, None, "und"), (51, "", "und"), (52, "123 !!", "und"), (53, both, "aa"), (None, rows[0][1], "aa"), (0, rows[0][1], "aa")]
    frame = spark.createDataFrame([(i, t, e) for i, t, e in rows], "doc_id long, text string, score string")
    out = language.identified(frame, model).collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in out) == sorted((str(i), e) for i, _, e in rows)
    assert all(0 <= r.score <= 1 for r in out)
    mixed = next(r for r in out if r.doc_id == 53)
    assert mixed.languages.startswith("aa:0.6") and ",bb:0.3" in mixed.languages
    assert language.identified(frame.limit(0), model).count() == 0
    nothing = language.learn(frame.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {r.lang_pred for r in language.identified(frame, nothing).collect()} == {"und"}


def labelled(n, seed):
    """Texts and labels of three categories; the last one needs the two before."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        insult, threat = rng.random() < 0.3, rng.random() < 0.3
        parts = prose(seed * 1000 + i, 30).split() + ["clodhead"] * insult + ["burnyou"] * threat
        rng.shuffle(parts)
        rows.append((i, " ".join(parts), int(insult), int(threat), int(insult or threat)))
    return rows


def test_classifier_chain(spark):
    schema = "doc_id long, text string, insult int, threat int, toxic int"
    names = ("insult", "threat", "toxic")
    frame = spark.createDataFrame([*labelled(400, 1), (None, "clodhead", 1, 0, 1), (5000, None, 0, 0, 0)], schema)
    chain = toxicity.train(frame.select("doc_id", "text"), frame.drop("text"), names)
    assert [len(m.earlier) for m in chain] == [0, 1, 2] and (chain[2].earlier != 0).any()
    test = spark.createDataFrame(labelled(200, 2), schema)
    out = toxicity.scored(test, chain, names).collect()
    for c in names:
        assert sum((r[f"p_{c}"] >= 0.5) == bool(r[c]) for r in out) >= 196
    odd = toxicity.scored(documents(spark, ODD).withColumn("p_toxic", F.lit("clash")), chain, names)
    assert odd.count() == len(ODD) and odd.columns == [*documents(spark, []).columns, *[f"p_{c}" for c in names]]
    assert toxicity.scored(documents(spark, []), chain, names).count() == 0
    unlabelled = toxicity.train(frame.select("doc_id", "text"), frame.drop("text").limit(0), names)
    assert {r.p_toxic for r in toxicity.scored(test, unlabelled, names).collect()} == {0.5}


def test_toxicity_decides(spark):
    rows = labelled(500, 3)
    docs = documents(spark, [(r[0], r[1], "s") for r in rows])
    labels = spark.createDataFrame([(r[0], 1, r[4]) for r in rows], "doc_id long, quality int, toxic int")
    out = {r.doc_id: r.is_toxic for r in toxicity.toxicity(docs, labels).collect()}
    assert sum(out[r[0]] == bool(r[4]) for r in rows) >= 495


def test_quality_scores(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        good = rng.random() < 0.7
        text = prose(3000 + i, 40)
        rows.append((i, text if good else (text.upper() + "!!" if i % 2 else " ".join(w for w in text.split()[:10] for _ in range(4))), int(good)))
    frame = spark.createDataFrame([*rows, (None, "x", 1), (900, None, 1)], "doc_id long, text string, quality int")
    model = quality.train(frame.where("doc_id % 2 = 0 or doc_id is null").select("doc_id", "text"), frame.select("doc_id", "quality"))
    score = {r.doc_id: r.score for r in quality.scored(frame.where("doc_id % 2 = 1"), model).collect()}
    assert sum((score[i] >= 0.5) == bool(y) for i, _, y in rows if i % 2) >= 196
    odd = quality.scored(documents(spark, ODD).withColumn("score", F.lit("clash")), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert quality.scored(documents(spark, []), model).count() == 0
    alone = quality.train(frame.select("doc_id", "text"), frame.where("quality = 1").select("doc_id", "quality"))
    assert all(r.score > 0.9 for r in quality.scored(frame, alone).collect())


def test_dual_descent_reaches_the_optimum():
    """The duality gap of the hinge-loss problem closes."""
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 60, 8)).astype(np.int32) for _ in range(200)]
    y = np.array([int((r < 20).sum() + rng.normal() > 2.5) for r in rows])
    ratio = quality.count_ratios(rows, y)
    w, b = quality.dual_descent(rows, y, ratio)
    sign, cost = np.where(y > 0, 1, -1), np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y <= 0).sum()))

    def loss(w, b):
        margin = np.array([ratio[r] @ w[r] / np.linalg.norm(ratio[r]) + b for r in rows])
        return (w @ w + b * b) / 2 + (cost * np.maximum(0, 1 - sign * margin)).sum()

    best = loss(w, b)
    for _ in range(200):
        assert loss(w + rng.normal(0, 0.05, len(w)) * (w != 0), b + rng.normal(0, 0.05)) > best * 0.98


ARTICLE = "<article><h1>A &amp; B</h1><p>One <b>bold</b> text<br>second line.<p>Two\n\tspaced</p><ul><li>x<li>y</ul></article>"


def test_main_text(spark):
    def page(i, body):
        return (i, f"https://Host{i % 2}.example/{i}", f"<!DOCTYPE html><html><head><title>T</title><script>if (a<b) '</p>'</script><style>p{{}}</style></head><body>{body}</body></html>", 1)

    menu = '<nav><ul><li><a href="/">Home</a></ul></nav><header>Site</header><div class="cookie-notice">We use cookies</div>'
    tail = '<aside>side</aside><form><p>mail</p></form><section id="comments"><p>nice!</p></section><div class="ad">buy</div><footer>&copy; me</footer>'
    rows = [page(1, menu + ARTICLE + tail), page(2, menu + "<div><p>plain &lt;page&gt;</p>text</div>" + tail), (3, None, None, 1), (4, "not a url", "", 1), (5, None, "just text", 1), page(6, "<!-- c --><p>open <i>it<p>next" + "<script>never closed"), page(7, ARTICLE), page(7, ARTICLE)]
    out = html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, cut int"))
    found = {(r.page_id, r.text) for r in out.collect()}
    article = "A & B\n\nOne bold text second line.\n\nTwo spaced\n\nx\n\ny"
    assert found == {(1, article), (2, "plain <page>\n\ntext"), (3, ""), (4, ""), (5, "just text"), (6, "open it\n\nnext"), (7, article)}
    assert out.count() == len(rows) and all(r.n_chars == len(r.text) for r in out.collect())
    assert html.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_site_style_tree_cuts_repeated_branches(spark):
    """A branch that says the same on each page of a host goes, copies of pages count once."""
    rows = [(i, f"https://a.example/{i}", f"<div class='strip'>Welcome to the site</div><div class='text'><p>{prose(i, 12)}</p><p>Shared line.</p></div>") for i in range(12)]
    rows += [(100 + i, "https://b.example/", "<div class='text'><p>same page</p></div>") for i in range(20)]
    out = {r.page_id: r.text for r in html.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i] == f"{prose(i, 12)}\n\nShared line." for i in range(12))
    assert all(out[100 + i] == "same page" for i in range(20))


def test_crc_matches_the_contract(spark):
    from staywise.llm.common import remainder

    frame = spark.createDataFrame([(i,) for i in (0, 1, 25, 123456)], "doc_id long")
    assert [r[0] for r in frame.select(remainder(F.col("doc_id"))).collect()] == [zlib.crc32(str(i).encode()) % 5 for i in (0, 1, 25, 123456)]
