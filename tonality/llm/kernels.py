"""Numpy kernels on Arrow string arrays; they run inside ``mapInArrow`` tasks.

Words are handled as 64-bit fingerprints computed for a whole slice of rows at
once. A word's fingerprint depends on its bytes only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15 | 1
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


def is_word_byte_table(white: bytes = b" \t\n\x0b\x0c\r") -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[np.frombuffer(white, np.uint8)] = False
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers whose output bits all depend on all
    input bits (the SplitMix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, odd: int = _ODD):
        self.odd, self.inverse = odd, pow(odd, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up = self._run(self.odd, size)
            self.down = self._run(self.inverse, size)
        return self.up[:n], self.down[:n]

    @staticmethod
    def _run(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


def sums_before(values: np.ndarray) -> np.ndarray:
    """``out[i]`` is the sum of the first i values (modulo 2**64 for uint64)."""
    out = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=out[1:])
    return out


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values ascending, a place of each, which of them each key is).
    Unlike ``np.unique`` it takes any place, not the first, so that it needs no
    stable sort, which is slower."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    inverse = np.empty(len(key), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return ordered[new], order[new], inverse


def string_parts(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of an Arrow string array; null counts as empty."""
    if arr.null_count:
        arr = arr.fill_null("" if pa.types.is_string(arr.type) or pa.types.is_large_string(arr.type) else b"")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offsets, data = arr.buffers()
    if len(arr) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(arr) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    off = np.frombuffer(offsets, kind, len(arr) + 1, arr.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch whose texts take about ``size`` bytes (at least a
    row each), so that working arrays stay small whatever the batch holds."""
    _, off = string_parts(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


class Words:
    """The words of a run of texts.

    ``start``/``end``: byte span of each word in ``raw``; ``first``: for each
    text the number of words before it (one more entry at the end);
    ``key``: the fingerprint of each word.
    """

    def __init__(self, arr: pa.Array, powers: Powers, word_bytes: np.ndarray, fold: np.ndarray | None = None):
        self.raw, self.offsets = string_parts(arr)
        if fold is not None:
            self.raw = fold[self.raw]
        inside = word_bytes[self.raw]
        n = len(inside)
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = self.offsets[:-1]
        edges = edges[edges < n]
        begins[edges] = inside[edges]
        stops = np.zeros(n + 1, bool)  # stops[i]: a word ends just before byte i
        stops[1:n] = inside[:-1] & ~inside[1:]
        if n:
            stops[n] = inside[-1]
            inner = edges[edges > 0]
            stops[inner] = inside[inner - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(stops)
        self.first = np.searchsorted(self.start, self.offsets, "left")
        up, down = powers.upto(n + 1)
        self._run, self._down = sums_before((self.raw.astype(np.uint64) + np.uint64(1)) * up[:n]), down
        self.key = self._keys(self.start, self.end)

    def _keys(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._run[end] - self._run[start]) * self._down[start])

    def prefixes(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the words longer than n bytes: their numbers, and fingerprints of
        their first n bytes, which differ from those of words."""
        long = np.flatnonzero(self.end - self.start > n)
        return long, mix(self._keys(self.start[long], self.start[long] + n) ^ np.uint64(0x94D049BB133111EB))

    def __len__(self) -> int:
        return len(self.start)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.end[i]].tobytes()


def runs_of(keys: np.ndarray, first: np.ndarray, width: int, odd: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the runs of ``width`` words inside each text.

    A text of fewer words (but at least one) has its whole word sequence as its
    only run. Returns (fingerprints, number of runs before each text).
    """
    n_words = np.diff(first)
    count = np.where(n_words >= width, n_words - width + 1, (n_words > 0).astype(n_words.dtype))
    before = sums_before(count.astype(np.int64))
    start = np.repeat(first[:-1], count) + (np.arange(before[-1]) - np.repeat(before[:-1], count))
    length = np.minimum(np.repeat(n_words, count), width)
    out = np.zeros(len(start), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            has = length > k
            if has.all():
                out = out * np.uint64(odd) + keys[start + k]
            else:
                out[has] = out[has] * np.uint64(odd) + keys[start[has] + k]
        return mix(out + length.astype(np.uint64)), before


def key_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, as tables, from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = np.zeros(batch.num_rows, bool)
        for c in keys:
            code = batch.column(c).to_numpy(zero_copy_only=False)
            cut[1:] |= code[1:] != code[:-1]
        at = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
        for a, b in zip(at[:-1], at[1:], strict=True):
            key = tuple(batch.column(c)[a].as_py() for c in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)
