"""Packing documents into fixed-length sequences along a Hilbert curve.

A document's hashed word vector is projected to three dimensions and gets the
key of its cell on a Hilbert curve, so documents with similar vectors are close
in the order of the keys. The documents are laid end to end in that order and
cut every ``length`` tokens: every sequence but the last is full, and a
sequence holds neighbours along the curve.

The ids are computed once and written to the shared folder with a row number;
the order, and the running sums that give each document its place, are
computed on (row number, count, key) only. The places come back by one join.

Defined results: a null or empty text is the end id alone; null and repeated
ids are rows like any other (ties on the curve go by id, then row number); an
empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from struct import pack as pack_numbers

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, text_or_empty
from .kernels import Powers, Words, is_word_byte_table, mix, slices, sums_before
from .token_counts import byte_of_char

LENGTH = 2048
END_ID = 1
DIMENSIONS, BITS = 3, 10
_CELLS = 9  # log2 of the buckets of the hashed word vector (sign included)
CACHE = 250_000


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """Ids of the white-space separated words of a text, by a ``tokenizers``
    file whose pre-tokenizer never joins words across ASCII white space.

    Words are encoded once and kept in a bounded cache of two generations: when
    the younger is full, it replaces the older. A-Z are lower-cased first, as the
    tokenizer does anyway. A plain word (lower-case Latin letters, then perhaps
    ASCII punctuation) is one or two pre-tokens, which go straight to the model;
    any other word is encoded by the whole tokenizer.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.plain = re.compile("([a-zß-öø-ÿ]+)([!-&(-/:-@[-`{-~]*)")
        self.alphabet = {b: c for c, b in byte_of_char().items()}
        self.stops = {m: self._numbers([t.id for t in self.model.tokenize(m.decode())]) for m in (b".", b",", b"|")}

    def _encode(self, word: bytes) -> bytes:
        """Ids of a word whose A-Z are lower-cased."""
        if word.isalpha():  # ASCII letters
            ids = [t.id for t in self.model.tokenize(word.decode())]
        elif word[-1:] in self.stops and (stem := word[:-1]).isalpha():
            return self._learn(stem) + self.stops[word[-1:]]
        elif (match := self.plain.fullmatch(text := word.decode())) is None:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        elif punctuation := match[2]:
            if punctuation not in self.marks:
                if len(self.marks) >= CACHE:
                    self.marks.clear()
                self.marks[punctuation] = self._numbers([t.id for t in self.model.tokenize(punctuation)])
            return self._learn(match[1].encode()) + self.marks[punctuation]
        else:
            ids = [t.id for t in self.model.tokenize(word.decode("latin-1").translate(self.alphabet))]
        return self._numbers(ids)

    def _numbers(self, ids: list[int]) -> bytes:
        return pack_numbers(f"<{len(ids)}{self.kind.char}", *ids)

    def _learn(self, word: bytes) -> bytes:
        ids = self.young.get(word)
        if ids is None:
            ids = self.old.get(word)
            if ids is None:
                ids = self._encode(word)
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[word] = ids
        return ids

    def of_text(self, text: str | None) -> bytes:
        raw = (text or "").encode()
        if b"<|" in raw:  # perhaps a special token, which is matched as it is written
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        # lower-cases ASCII and splits at ASCII white space only
        return b"".join(map(self._learn, raw.lower().split()))

    def of_texts(self, texts: pa.Array, w: Words, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids before each text) of a run of texts with words ``w``, the
        end id after each. Each distinct word of the run is looked up once."""
        raw = w.raw.tobytes()
        if b"<|" in raw:
            each = [np.frombuffer(self.of_text(t), self.kind) for t in texts.to_pylist()]
            ids, before = np.concatenate([*each, np.zeros(0, self.kind)]), sums_before(np.array([len(x) for x in each], np.int64))
        else:
            _, at, inverse = np.unique(w.key, return_index=True, return_inverse=True)
            words = [raw[s:e].lower() for s, e in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)]
            known = self.young.get
            found = [known(x) or self._learn(x) for x in words]
            size = np.array([len(x) for x in found], np.int64) // self.kind.itemsize
            own, n = np.frombuffer(b"".join(found), self.kind), size[inverse]
            so_far = sums_before(n)
            place = np.arange(so_far[-1]) + np.repeat(sums_before(size)[:-1][inverse] - so_far[:-1], n)
            ids, before = own[place], so_far[w.first]
        return np.insert(ids, before[1:], end_id), before + np.arange(len(before))


def projection() -> np.ndarray:
    """A fixed table, bucket of the hashed vector -> integer coordinates, near
    normal with mean 0 and standard deviation about 1000."""
    cell = np.arange((1 << (_CELLS - 1)) * DIMENSIONS * 12, dtype=np.uint64)
    uniform = (mix(cell + np.uint64(1)) >> np.uint64(40)).astype(np.int64).reshape(-1, DIMENSIONS, 12)
    half = (uniform.sum(axis=2) - (6 << 24)) * 1000 >> 24
    return np.concatenate([half, -half])  # the second half: opposite sign


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position of integer cells (n, d) on the d-dimensional Hilbert curve of
    ``bits`` levels (the transpose method: undo excess work, then Gray code)."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        below = level - 1
        for i in range(d):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(high, below, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        turn ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def curve_keys(w: Words, table: np.ndarray) -> np.ndarray:
    """Hilbert key of each text: sums of its words' coordinates over the square
    root of their number, squashed to a cube of 2**BITS cells a side."""
    bucket = (w.key >> np.uint64(64 - _CELLS)).astype(np.int64)
    n = np.maximum(np.diff(w.first), 1)
    cells = np.empty((len(n), DIMENSIONS), np.int64)
    for k in range(DIMENSIONS):
        run = sums_before(table[bucket, k])
        x = (run[w.first[1:]] - run[w.first[:-1]]) / (1000 * np.sqrt(n))
        cells[:, k] = np.floor((1 + np.tanh(x / 4)) / 2 * ((1 << BITS) - 1e-6))
    return hilbert_key(cells)


TOKEN_SCHEMA = "doc_id long, n long, curve long, ids binary"


def _tokens(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, powers, inside, table = WordIds(path), Powers(), is_word_byte_table(), projection()
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"), powers, inside)
                numbers, before = ids.of_texts(part.column("text"), w, end_id)
                offsets = pa.py_buffer((before * ids.kind.itemsize).astype(np.int32))
                found = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, offsets, pa.py_buffer(numbers)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(before)), pa.array(curve_keys(w, table)), found],
                    ["doc_id", "n", "curve", "ids"],
                )

    return run


PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, curve long"


def _pieces(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "ids"):
                n, place = (part.column(c).to_numpy() for c in ("n", "place"))
                first, last = place // length, (place + n - 1) // length
                count = last - first + 1
                row = np.repeat(np.arange(len(n)), count)
                before = sums_before(count)
                sequence = first[row] + np.arange(before[-1]) - before[row]
                start = np.maximum(sequence * length - place[row], 0)
                stop = np.minimum((sequence + 1) * length - place[row], n[row])
                raw = [np.frombuffer(x.as_buffer(), "<u2" if len(x.as_buffer()) == 2 * k else "<u4") for x, k in zip(part.column("ids"), n.tolist(), strict=True)]
                cut = [raw[r][a:b].astype("<u4").tobytes() for r, a, b in zip(row.tolist(), start.tolist(), stop.tolist(), strict=True)]
                pick = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pick),
                        pa.array(start),
                        pa.array(stop - start),
                        pa.array(cut, pa.binary()),
                        part.column("n").take(pick),
                        pa.array(sequence),
                        pa.array((place[row] + start) % length),
                        part.column("curve").take(pick),
                    ],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "curve"],
                )

    return run


def places(tokens: DataFrame) -> DataFrame:
    """``row, place``: where each document starts in the concatenation along
    the curve. Range partitions keep every sort and running sum bounded; only
    one total per partition meets in one task."""
    narrow = tokens.select("row", "doc_id", "n", "curve").repartitionByRange("curve", "doc_id", "row")
    parts = materialise(narrow.withColumn("part", F.spark_partition_id()), "curve")
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("curve", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    local = parts.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return local.join(base, "part").select("row", (F.col("base") + F.col("before")).alias("place"))


def pack(docs: DataFrame, length: int = LENGTH, path: str | None = None, end_id: int = END_ID, text: str = "text") -> DataFrame:
    """The pieces of all documents: ``doc_id, start, length, ids`` (little-endian
    unsigned 32-bit), ``doc_tokens, sequence_id, offset, curve``."""
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    tokens = source.mapInArrow(_tokens(path or tokenizer_path(), end_id), TOKEN_SCHEMA)
    tokens = materialise(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens")
    placed = tokens.join(places(tokens), "row").select("doc_id", "n", "curve", "ids", "place")
    return placed.mapInArrow(_pieces(length), PIECE_SCHEMA)
