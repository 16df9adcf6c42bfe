"""Alignment of two tokenizers by brute force, whatever the byte ranges, and the monoid's laws."""

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import pytest

tokenizers_files = pytest.importorskip("public_tokenizers")

from staywise.llm import alignment  # noqa: E402

A, B = tokenizers_files.path("byte_bpe_50k.json"), tokenizers_files.path("piece_bpe_32k.model")
ALPHABET = " \n\tabcdefghijz'.,éß日本😀0123 the "
ODD = [
    (1, " a  b "), (2, ""), (None, None), (3, "x▁y z"), (3, "x▁y z"), (4, "<s>hi</s> <|endoftext|> x"), (5, "\n\nx \t \n y\n z"), (6, "日本語 中文。🙂𐍈 "),
    (7, "é" * 3000 + " abc"), (8, "don't  I'll 12345 6 7    x  y "), (9, " "), (10, "  "), (11, "a\x1c b"), (12, "word " * 4000), (13, "\x00 \r\n"), (None, "same"), (None, "same"),
]


def noise(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return "".join(rng.choice(ALPHABET) for _ in range(n))


ROWS = ODD + [(100 + k, noise(k, 37 * k % 600)) for k in range(40)]


def documents(spark, rows):
    """Rows (doc_id, text); further columns clash with names used inside the operator."""
    return spark.createDataFrame([(i, t, 1, "p", 2) for i, t in rows], "doc_id long, text string, row int, pairs string, at long")


def groups_of(text):
    """Pairs of id lists, from both libraries on the whole text."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    if not text:
        return []
    byte_of = alignment._byte_of()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    data_a = [bytes(byte_of[c] for c in a.id_to_token(k)) for k in ids_a]
    names = [b.id_to_piece(k) for k in ids_b]
    data_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in names]
    if not b"".join(data_a) == b"".join(data_b) == (" " + text).encode():
        return []
    out, i, j, at_a, at_b, begin_a, begin_b = [], 0, 0, 0, 0, 0, 0
    while i < len(ids_a) or j < len(ids_b):
        if at_a <= at_b:
            at_a += len(data_a[i])
            i += 1
        else:
            at_b += len(data_b[j])
            j += 1
        if at_a == at_b:
            out.append((ids_a[begin_a:i], ids_b[begin_b:j]))
            begin_a, begin_b = i, j
    return out


@pytest.fixture(scope="module")
def expected():
    groups = [(i, groups_of(t)) for i, t in ROWS]
    links = [[(x, y) for a, b in g for x in a for y in b] for _, g in groups]
    count = Counter(p for found in links for p in set(found))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (i, g), found in zip(groups, links, strict=True):
        line = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        digest = hashlib.sha256(line.encode()).hexdigest() if g else ""
        best = sum(count[p] == most[p[0]] for p in found)
        out.append((str(i), sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(found), best, sum(count[p] for p in found), digest))
    return sorted(out)


@pytest.mark.parametrize(("size", "head"), [(1 << 16, 1 << 19), (64, 50), (7, 1)])
def test_by_brute_force(spark, monkeypatch, expected, size, head):
    """The same result whether a text is one range or many, and whether counts are broadcast or joined."""
    monkeypatch.setattr(alignment, "HEAD", head)
    found = alignment.alignment(documents(spark, ROWS), A, B, size).collect()
    assert sorted((str(r.doc_id), *tuple(r)[1:]) for r in found) == expected


def test_composition_is_associative():
    aligner = alignment.Aligner(A, B)
    for seed in range(6):
        text = noise(seed, 400)
        parts = [aligner.range_of(*r) for r in alignment.ranges(text, 9)]
        assert len(parts) > 20
        (whole,) = aligner.texts_of([text])
        rng, shown = random.Random(seed), parts
        while len(shown) > 1:  # join neighbours in any order
            k = rng.randrange(len(shown) - 1)
            shown = [*shown[:k], alignment.compose(shown[k], shown[k + 1]), *shown[k + 2 :]]
        for top in (shown[0], reduce(alignment.compose, parts, alignment.EMPTY)):
            done = alignment.whole(top)
            assert (done.text, done.n_links, done.pairs.tolist(), done.times.tolist()) == (whole.text, whole.n_links, whole.pairs.tolist(), whole.times.tolist())
            assert not done.head_a and not done.tail_a


def test_open_ends_occur():
    """Ranges that end within a unit leave tokens open."""
    aligner = alignment.Aligner(A, B)
    parts = [aligner.range_of(*r) for r in alignment.ranges("unbelievable transformations " * 20, 25)]
    assert any(p.tail_a or p.tail_b for p in parts) and any(not p.cut for p in parts) or any(p.head_a for p in parts)


def test_memory_of_units_is_bounded():
    aligner = alignment.Aligner(A, B, remembered=20)
    texts = [noise(k, 300) for k in range(20)]
    plain = alignment.Aligner(A, B).texts_of(texts)
    for text, whole in zip(texts, plain, strict=True):
        (found,) = aligner.texts_of([text])
        assert found.text == whole.text and len(aligner.place) <= 20


def test_empty_table(spark):
    assert alignment.alignment(documents(spark, []), A, B).collect() == []
