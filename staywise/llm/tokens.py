"""Token counts with a whole-token shortcut.

A byte-level BPE tokenizer splits a text into pre-tokens and merges bytes within each of
them. Ahead of the run every string of the vocabulary is tried alone: those that the
library encodes as one single token form a table (``whole_tokens``). While counting, a pre-token
in the table counts one without any merging; only the others go through the library's
merges, each distinct one once for as long as it is remembered.

The pre-token pattern runs in the ``regex`` module. Characters that it classes in another
way than the library are found by trying all of them (``odd_characters``); a text that holds
one is encoded whole by the library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The split of byte-level BPE (fixed by the tokenizer format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Distinct pre-tokens a task remembers besides the table.
REMEMBERED = 500_000
#: Pre-tokens looked up together.
TOGETHER = 200_000
LIMIT = 1024


def load(path: str):
    """The tokenizer of a file; only plain byte-level BPE is supported."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        layout = json.load(file)
    split = layout.get("pre_tokenizer") or {}
    if layout.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        raise ValueError(f"{path} is no plain byte-level BPE tokenizer")
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    special = [t["content"] for t in layout.get("added_tokens", [])]
    return tokenizer, special


def whole_tokens(tokenizer, special: list[str]) -> set[str]:
    """The vocabulary's strings that alone are one pre-token and encode as one token."""
    texts = [tokenizer.decode([k], skip_special_tokens=False) for k in tokenizer.get_vocab().values()]
    texts = [t for t in texts if t and "�" not in t and t not in special]
    return {t for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True) if len(e.ids) == 1 and regex.fullmatch(PATTERN, t)}


def odd_characters(tokenizer) -> str:
    """A character class of what the library may split in another way than the pattern does.

    Tries each code point of the planes in use between a letter and a digit, where its class
    shows. Code points of the other planes are all taken as odd.
    """
    find, split = regex.compile(PATTERN).findall, tokenizer.pre_tokenizer.pre_tokenize_str

    def differ(codes: list[int]) -> bool:
        text = "\n".join(f"a{chr(c)}1{chr(c)}!" for c in codes)
        return find(text) != [text[a:b] for _, (a, b) in split(text)]

    planes = [*range(0xD800), *range(0xE000, 0x40000), *range(0xE0000, 0xF0000)]
    odd = []
    for at in range(0, len(planes), 512):
        if differ(planes[at : at + 512]):
            odd += [c for c in planes[at : at + 512] if differ([c])]
    ranges, start = [], None
    for code, after in zip(odd, [*odd[1:], None], strict=True):
        start = code if start is None else start
        if after != code + 1:
            ranges.append(f"\\U{start:08x}-\\U{code:08x}")
            start = None
    return "[" + "".join([*ranges, r"\U00040000-\U000dffff\U000f0000-\U0010ffff"]) + "]"


class Counter:
    """Counts tokens of texts; ``table`` and ``odd`` come from the two functions above."""

    def __init__(self, tokenizer, special: list[str], table: set[str], odd: str) -> None:
        self.tokenizer, self.find, self.odd = tokenizer, regex.compile(PATTERN).findall, re.compile(odd)
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.whole = dict.fromkeys(table, 1)
        self.known = dict(self.whole)

    def pieces(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and the number of special tokens in it."""
        if self.special is None or not self.special.search(text):
            return self.find(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in self.find(part)], len(parts) - 1

    def _learn(self, pieces: set[str]) -> None:
        rest = list(pieces.difference(self.known))
        if len(self.known) + len(rest) > len(self.whole) + REMEMBERED:
            self.known = dict(self.whole)
            rest = list(pieces.difference(self.known))
        for at in range(0, len(rest), 10_000):
            some = rest[at : at + 10_000]
            self.known.update((p, len(e.ids)) for p, e in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False), strict=True))

    def counts(self, texts: list[str | None]) -> list[int]:
        out: list[int] = []
        waiting: list[tuple[list[str], int]] = []
        held = 0

        def settle() -> None:
            self._learn(set().union(*[p for p, _ in waiting]))
            out.extend(n + sum(map(self.known.__getitem__, p)) for p, n in waiting)
            waiting.clear()

        for text in texts:
            if text and self.odd.search(text):
                waiting.append(([], len(self.tokenizer.encode(text, add_special_tokens=False).ids)))
            else:
                waiting.append(self.pieces(text) if text else ([], 0))
            held += len(waiting[-1][0])
            if held > TOGETHER:
                settle()
                held = 0
        settle()
        return out


@cache
def prepared(path: str) -> tuple[set[str], str]:
    """The table and the odd characters of a tokenizer file, found once in a driver's life."""
    tokenizer, special = load(path)
    return whole_tokens(tokenizer, special), odd_characters(tokenizer)


def token_counts(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more tokens than ``limit``) per row.

    Counts what the library gives without added special tokens, padding or truncation; the
    strings of special tokens in a text count as the library's default has them, one token
    each. Null and empty texts count zero. ``path`` must exist on all workers.
    """
    shared = documents.sparkSession.sparkContext.broadcast(prepared(path))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*load(path), *shared.value)
        for batch in batches:
            counts: list[int] = []
            for at in range(0, batch.num_rows, 512):
                counts += counter.counts(batch.column(1).slice(at, 512).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kept = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    kind = documents.schema["doc_id"].dataType.simpleString()
    return kept.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
