"""Removal of long repeated passages: seed and extend on winnowed anchors.

A window is ``min_words`` (50) consecutive words of one document. A word is
removed if it lies in a window whose word sequence also starts in a document
with a smaller ``doc_id``; windows are judged on the input.

* Seed. Every window is represented by the smallest fingerprint among its
  8-word runs, its anchor. Equal windows have equal anchors, and neighbouring
  windows mostly share theirs, so there is one seed per about 22 words: the
  run of windows around an anchor, with the fingerprint of all its words.
* Join. Seeds are joined on the anchor; anchors of a single document go.
* Extend. The seed's stretch reaches left and right as far as its windows
  have this anchor. Where all stretches of an anchor are equal, the whole
  stretch is a repeat. Where they differ (at the ends of a shared passage,
  around an edit), one document per distinct stretch is extended word by word
  to each side, by comparing fingerprints of its windows. Comparing
  fingerprints instead of pairs of documents keeps the work linear in the
  number of seeds, however many documents share a passage. Repeated rows give
  equal seeds and windows, which partial aggregates keep once.
* The union of the repeats found this way gives the maximal repeats of a
  document, each at least ``min_words`` long.

Windows are compared by two independent 64-bit fingerprints (of the anchor and
of the words).

Defined results: null text has no words; a text of fewer than ``min_words``
words keeps all; rows with a null ``doc_id`` are not compared and keep all;
rows that share a ``doc_id`` don't remove from each other; in an exact copy
everything that windows cover goes; an empty table gives an empty result;
further columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import bounded_batches, materialise, text_or_empty
from .kernels import Powers, Words, is_word_byte_table, mix, slices, sums_before

MIN_WORDS = 50
ANCHOR_WORDS = 8
_RUN = 0xD1B54A32D192ED03
_STRETCH = 0xABC98388FB8FAC03


def _runs(keys: np.ndarray, width: int) -> np.ndarray:
    """Fingerprints of all runs of ``width`` consecutive words of the array."""
    n = len(keys) - width + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(width):
        out = out * np.uint64(_RUN) + keys[k : k + len(out)]
    return mix(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    size, now = 1, values
    while 2 * size <= width:
        now = np.minimum(now[: len(now) - size], now[size:])
        size *= 2
    rest = width - size
    return np.minimum(now[: len(now) - rest], now[rest:]) if rest else now


def seeds(w: Words, powers: Powers, min_words: int = MIN_WORDS) -> dict[str, np.ndarray]:
    """The seeds of a run of texts: text number, anchor, fingerprint of the
    stretch, number of its first window in the text, and number of windows."""
    width = min_words - ANCHOR_WORDS + 1
    n_windows = np.maximum(np.diff(w.first) - min_words + 1, 0)
    if not n_windows.any():
        return {k: np.zeros(0, np.int64) for k in ("text", "anchor", "stretch", "start", "n")}
    runs = _runs(w.key, ANCHOR_WORDS)
    low = np.uint64(63)
    marked = (runs & ~low) | (np.arange(len(runs)).astype(np.uint64) & low)
    least = _least(marked, width)
    text = np.repeat(np.arange(len(n_windows)), n_windows)
    before = sums_before(n_windows)
    at = w.first[:-1][text] + np.arange(before[-1]) - before[text]
    value = least[at]
    anchor_at = at + (((value & low).astype(np.int64) - at) & 63)
    new = np.ones(len(at), bool)
    new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (text[1:] != text[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(at)))
    begin = at[head]
    end = begin + count + min_words - 1
    up, down = powers.upto(len(w.key) + 1)
    total = sums_before(w.key * up[: len(w.key)])
    stretch = mix((total[end] - total[begin]) * down[begin] + count.astype(np.uint64))
    return {
        "text": text[head],
        "anchor": (value[head] & ~low).view(np.int64),
        "stretch": stretch.view(np.int64),
        "start": begin - w.first[:-1][text[head]],
        "n": count,
    }


SEED_SCHEMA = "anchor long, stretch long, doc_id long, copy long, start int, n int"


def _seed_rows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte_powers, word_powers, inside = Powers(), Powers(_STRETCH), is_word_byte_table()
        for batch in batches:
            for part in slices(batch):
                found = seeds(Words(part.column("text"), byte_powers, inside), word_powers, min_words)
                row = pa.array(found["text"])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found["anchor"]),
                        pa.array(found["stretch"]),
                        part.column("doc_id").take(row),
                        part.column("copy").take(row),
                        pa.array(found["start"].astype(np.int32)),
                        pa.array(found["n"].astype(np.int32)),
                    ],
                    ["anchor", "stretch", "doc_id", "copy", "start", "n"],
                )

    return run


WINDOW_SCHEMA = "anchor long, window long, doc_id long, copy long, start int"


def _window_rows(min_words: int):
    """The windows of the listed stretches of each text, with fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, inside = Powers(), is_word_byte_table()
        for batch in batches:
            for part in slices(batch):
                w = Words(part.column("text"), powers, inside)
                lists = part.column("stretches")
                each = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten()
                row = np.repeat(np.arange(part.num_rows), each)
                start = flat.field("start").to_numpy().astype(np.int64)
                n = flat.field("n").to_numpy().astype(np.int64)
                pick = np.repeat(np.arange(len(n)), n)
                before = sums_before(n)
                at = start[pick] + np.arange(before[-1]) - before[pick]
                begin = w.first[:-1][row[pick]] + at
                value = np.zeros(len(begin), np.uint64)
                for k in range(min_words):
                    value = value * np.uint64(_STRETCH) + w.key[begin + k]
                doc = pa.array(row[pick])
                yield pa.RecordBatch.from_arrays(
                    [
                        flat.field("anchor").take(pa.array(pick)),
                        pa.array(mix(value).view(np.int64)),
                        part.column("doc_id").take(doc),
                        part.column("copy").take(doc),
                        pa.array(at.astype(np.int32)),
                    ],
                    ["anchor", "window", "doc_id", "copy", "start"],
                )

    return run


def _identified(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, copy (tells apart texts that share an id) and text."""
    t = text_or_empty(text)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(t).alias("copy"), t.alias("text"))


def _once_each(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows equal in all columns once (a hash aggregate, combined in the tasks
    before its shuffle): repeated rows of the input give the same windows."""
    return rows.groupBy(*columns).agg(F.lit(1).alias("one")).select(*columns)


def repeats(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """``doc_id, copy, start, n``: runs of n windows, from window ``start`` on,
    that also start in a document with a smaller id."""
    bounded_batches(docs.sparkSession)
    source = _identified(docs, text).where("doc_id IS NOT NULL")
    seed = materialise(source.mapInArrow(_seed_rows(min_words), SEED_SCHEMA), "seeds")

    anchors = (
        seed.groupBy("anchor")
        .agg(
            F.min("doc_id").alias("lowest"),
            F.max("doc_id").alias("highest"),
            (F.min("stretch") != F.max("stretch")).alias("differ"),
        )
        .where("lowest < highest")
        .drop("highest")
    )
    # tables on both sides of a join: Spark can split a hot key's partition
    anchors = materialise(anchors, "anchors")
    shared = materialise(seed.join(anchors, "anchor").where("differ OR doc_id > lowest"), "shared")
    columns = ["doc_id", "copy", "start", "n"]
    alike = shared.where("NOT differ").select(columns)

    differ = shared.where("differ").select("anchor", "stretch", *columns)
    first = materialise(differ.groupBy("anchor", "stretch").agg(F.min("doc_id").alias("lowest")), "first")
    ranked = materialise(differ.join(first, ["anchor", "stretch"]), "stretches")
    again = ranked.where("doc_id > lowest").select(columns)

    lists = (
        ranked.where("doc_id = lowest")
        .groupBy("doc_id", "copy")
        .agg(F.collect_set(F.struct("anchor", "start", "n")).alias("stretches"))
    )
    found = source.join(lists, ["doc_id", "copy"]).mapInArrow(_window_rows(min_words), WINDOW_SCHEMA)
    window = materialise(_once_each(found, ["anchor", "window", "doc_id", "copy", "start"]), "windows")
    earliest = materialise(window.groupBy("anchor", "window").agg(F.min("doc_id").alias("lowest")), "earliest")
    extended = (
        window.join(earliest, ["anchor", "window"])
        .where("doc_id > lowest")
        .select("doc_id", "copy", "start", F.lit(1).alias("n"))
    )
    return alike.unionByName(again).unionByName(extended)


CUT_FIELDS = [
    StructField("n_words", LongType()),
    StructField("n_removed", LongType()),
    StructField("kept_text", StringType()),
    StructField("removed", ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))),
]


def _cut(texts: pa.Array, lists: pa.Array, min_words: int) -> tuple[list, list, list, list]:
    n_words, n_removed, kept, removed = [], [], [], []
    for text, found in zip(texts.to_pylist(), lists, strict=True):
        words = (text or "").encode().split()  # splits at ASCII white space only
        n, spans = len(words), []
        if found.is_valid and len(found.values):
            start = found.values.field("start").to_numpy()
            end = start + found.values.field("n").to_numpy() + min_words - 1
            delta = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
            gone = np.cumsum(delta[:n]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]
            words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        n_words.append(n)
        n_removed.append(n - len(words))
        kept.append(b" ".join(words).decode())
        removed.append(spans)
    return n_words, n_removed, kept, removed


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, text: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, rest, n_words, n_removed, kept_text,
    removed``. ``rest`` holds the columns of ``docs`` but the text; ``removed``
    the word spans [start, end) taken out; ``kept_text`` the other words,
    joined by a space."""
    found = repeats(docs, min_words, text)
    lists = found.groupBy("doc_id", "copy").agg(F.collect_set(F.struct("start", "n")).alias("found"))
    t = text_or_empty(text)
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text])
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(t).alias("copy"), F.col(text).alias("text"), rest.alias("rest")
    )
    joined = rows.join(lists, ["doc_id", "copy"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in slices(batch):
                n_words, n_removed, kept, removed = _cut(part.column("text"), part.column("found"), min_words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("rest"),
                        pa.array(n_words, pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(kept, pa.string()),
                        pa.array(removed, spans),
                    ],
                    ["doc_id", "rest", "n_words", "n_removed", "kept_text", "removed"],
                )

    return joined.mapInArrow(run, StructType([joined.schema["doc_id"], joined.schema["rest"], *CUT_FIELDS]))
