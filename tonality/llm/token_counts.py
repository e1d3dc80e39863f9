"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary becomes a trie over bytes. Each node has a failure link to the
node of what is left after popping the longest pieces at its front, and the
number of pieces popped on the way. A word is read once, symbol by symbol;
the automaton counts its pieces and never builds them.

Definitions: A-Z are lower-cased; a word is ``[^\\x20\\x09-\\x0D]+``; a piece
marked as a word end matches only there; where the greedy match leaves just
the end mark, it costs nothing; a word with a byte that no piece covers counts
as one (unknown) token.

Defined results: null and empty texts have no words and no tokens; rows are
counted one by one, so null or repeated ids give a row each; an empty table
gives an empty result; further columns stay as they are, but for those named
like an added column, which are replaced.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_or_empty
from .kernels import Powers, Words, is_word_byte_table, slices, sums_before

END = 256  # the symbol of a word's end
NONE = -1
CACHE = 1_000_000


def byte_of_char() -> dict[str, int]:
    """The printable alphabet of byte-level vocabularies: bytes that print stand
    for themselves, the others follow from code point 256 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def vocabulary(path: str, end_mark: str = "</w>") -> list[tuple[int, ...]]:
    """Pieces of a byte-level ``tokenizers`` file as symbols (bytes and END);
    special tokens are left out."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    to_byte, pieces = byte_of_char(), []
    for token in spec["model"]["vocab"]:
        if token in special:
            continue
        body = token.removesuffix(end_mark)
        if body and all(c in to_byte for c in body):
            pieces.append(tuple(to_byte[c] for c in body) + ((END,) if body != token else ()))
    return pieces


class Automaton:
    """``step``: node * 257 + symbol -> node; ``back``: failure link or NONE;
    ``popped``: pieces popped along the failure link."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        step: dict[int, int] = {}
        final, symbol, parent = [False], [0], [0]
        for piece in pieces:
            at = 0
            for s in piece:
                to = step.get(at * 257 + s)
                if to is None:
                    to = step[at * 257 + s] = len(final)
                    final.append(False)
                    symbol.append(s)
                    parent.append(at)
                at = to
            final[at] = True
        back, popped = [NONE] * len(final), [0] * len(final)
        children: list[list[int]] = [[] for _ in final]
        for child in range(1, len(final)):
            children[parent[child]].append(child)
        todo = deque(children[0])
        while todo:  # shallow nodes first
            v = todo.popleft()
            todo.extend(children[v])
            if final[v]:
                back[v], popped[v] = 0, 1
                continue
            at, n = back[parent[v]] if parent[v] else NONE, popped[parent[v]]
            while at != NONE and at * 257 + symbol[v] not in step:
                n += popped[at]
                at = back[at]
            if at != NONE:
                back[v], popped[v] = step[at * 257 + symbol[v]], n
        self.step, self.back, self.popped = step, back, popped

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest match of a word."""
        step, back, popped, at, n = self.step, self.back, self.popped, 0, 0
        for s in word:
            to = step.get(at * 257 + s)
            while to is None:
                if back[at] == NONE:
                    return 1
                n += popped[at]
                at = back[at]
                to = step.get(at * 257 + s)
            at = to
        to = step.get(at * 257 + END)
        while to is None and at:
            if back[at] == NONE:
                return 1
            n += popped[at]
            at = back[at]
            to = step.get(at * 257 + END)
        at = to or 0
        while at:
            if back[at] == NONE:
                return 1
            n += popped[at]
            at = back[at]
        return n


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


ADDED = ("n_words", "n_bytes", "n_tokens")


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_words, n_bytes, n_tokens`` (long)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(Automaton(vocabulary(path)))  # as large as the vocabulary
    rest = [c for c in docs.columns if c != text and c.lower() not in ADDED]
    source = docs.select(F.struct(*rest).alias("rest") if rest else F.lit(0).alias("rest"), text_or_empty(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, powers, inside, lower = shared.value, Powers(), is_word_byte_table(), lower_ascii()
        known: dict[int, int] = {}
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"), powers, inside, lower)
                key, at, inverse = np.unique(w.key, return_index=True, return_inverse=True)
                if len(known) + len(key) > CACHE:
                    known.clear()
                counts = []
                for k, i in zip(key.tolist(), at.tolist(), strict=True):
                    n = known.get(k)
                    if n is None:
                        n = known[k] = automaton.count(w.word(i))
                    counts.append(n)
                run_ = sums_before(np.array(counts, np.int64)[inverse] if counts else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("rest"),
                        pa.array(np.diff(w.first).astype(np.int64)),
                        pa.array(np.diff(w.offsets)),
                        pa.array(run_[w.first[1:]] - run_[w.first[:-1]]),
                    ],
                    ["rest", *ADDED],
                )

    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([source.schema["rest"], *[StructField(c, LongType()) for c in ADDED]])
    counted = source.mapInArrow(run, schema)
    return counted.select(*(["rest.*"] if rest else []), *ADDED)
