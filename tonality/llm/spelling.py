"""Grouping of spelling variants by asymmetric q-chunks.

Words are counted over all documents; two words are near if they differ by
exactly one inserted, deleted or replaced code point.

* Chunks and grams. A word of length L gives two disjoint chunks, its halves.
  A word of length L or L + 1 gives the positional grams that can meet such a
  chunk within a shift of one: its beginning of the first half's length at
  position 0, and what stands at the second half's position, shifted by the
  difference of the lengths. One edit touches one half only, so the other is
  preserved; words are joined on (L, half, gram) and verified.
* A pair is reported once: from the second half (beginnings equal) or else
  from the first, and by the shorter word, or the lesser of two equally long.
* Hot chunks. If a chunk is shared by so many words that the pairs of its
  bucket exceed ``BUCKET_PAIRS``, the edit is looked for in the halves of the
  other half: the words are dealt again by all they preserve around the
  smaller stretch, until a bucket is small or the stretch is one code point
  long. Buckets of one code point are small by themselves: their words differ
  at that place only. So no bucket is capped and nothing is lost.
* Forms. A word's form is its near word of largest count (ties: the smallest
  in code-point order) if that count is at least ``RATIO`` times its own. Counts
  grow by that ratio along forms, so chains are short, and the roots follow by
  pointer doubling.

Counting. Each task sums its words in a bounded table; Spark sums the sums.

Defined results: a null text has no words; a null id counts as the empty string
in the hash of ``typo``; repeated rows are counted each; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import islice
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise
from .kernels import slices

LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
BUCKET_PAIRS = 4096
TABLE_WORDS = 250_000
LONG_TEXT = 1 << 20
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def runs(text: str) -> Iterator[list[str]]:
    """The maximal letter runs of a text, with A-Z lower-cased, in portions."""
    if len(text) <= LONG_TEXT:
        yield RUN.findall(text.translate(LOWER))
        return
    found = RUN.finditer(text)
    while part := [m.group().translate(LOWER) for m in islice(found, 100_000)]:
        yield part


def typo(doc_id: str, run: str, seen: int) -> str:
    """Known spelling errors for trials: if 199 divides h, the unsigned crc32 of
    ``<doc_id>:<run>``, the code point h % length is deleted. ``seen`` is the
    crc32 of the part before the run."""
    h = crc32(run.encode(), seen)
    if h % 199:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def plain(doc_id: str, run: str, seen: int) -> str:
    return run


def _count_rows(change: Callable[[str, str, int], str], least_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"]
            )

        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    seen = crc32(f"{doc_id or ''}:".encode())
                    for found in runs(text):
                        for word, n in Counter(found).items():
                            word = change(doc_id, word, seen)
                            if len(word) >= least_length:
                                total[word] += n
                if len(total) >= TABLE_WORDS:
                    yield rows()
                    total.clear()
        if total:
            yield rows()

    return run


def count_words(docs: DataFrame, change: Callable[[str, str, int], str] = plain, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word, n`` of the letter runs of at least ``least_length`` code points."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    partial = rows.mapInArrow(_count_rows(change, least_length), "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


# --- pairs at distance one ----------------------------------------------------


def _cut(word: Column, start: Column, stop: Column) -> Column:
    """Code points [start, stop) of a word."""
    return F.substring(word, start + 1, stop - start)


def _around(word: Column, length: Column, grown: Column) -> Column:
    """What a word preserves around the stretch [a, b) of a word of ``length``
    code points; its own stretch is longer by ``grown``."""
    before = _cut(word, F.lit(0), F.col("a"))
    after = _cut(word, F.col("b") + grown, length + grown)
    return F.concat(before, F.lit(" "), after)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row once for either half of its stretch [a, b)."""
    middle = F.floor((F.col("a") + F.col("b")) / 2).cast("int")
    two = F.array(F.struct(F.col("a").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("b").alias("b")))
    rest = [c for c in rows.columns if c not in ("a", "b")]
    return rows.withColumn("half", F.explode(two)).select(*rest, "half.a", "half.b")


def _keyed(rows: DataFrame) -> DataFrame:
    """Dealt by (length, stretch, what is preserved around it)."""
    return rows.withColumn("key", _around(F.col("word"), F.col("length"), F.col("grown")))


def near_words(words: DataFrame, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """``x, y``: all pairs of the distinct ``word`` values at distance one, each
    once. Single code points and the empty word are compared like others."""
    length = F.length("word")
    sides = words.select("word", length.alias("own")).withColumn("grown", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    # grown -1: the word's chunks; 0 and 1: its grams for words as long, or shorter by one
    rows = sides.select(
        "word",
        (F.col("grown") < 0).alias("chunk"),
        F.greatest("grown", F.lit(0)).alias("grown"),
        (F.col("own") - F.greatest("grown", F.lit(0))).alias("length"),
        F.lit(0).alias("a"),
        (F.col("own") - F.greatest("grown", F.lit(0))).alias("b"),
    ).where("length >= 0")
    rows = _halves(rows)
    found: DataFrame | None = None
    place = ["length", "a", "b", "key"]
    while True:
        keyed = materialise(_keyed(rows), "grams")
        pairs = F.sum(F.col("chunk").cast("long")) * F.sum((~F.col("chunk")).cast("long"))
        size = keyed.groupBy(*place).agg(pairs.alias("pairs")).where("pairs > 0")
        hot = materialise(size.where((F.col("pairs") > bucket_pairs) & (F.col("b") - F.col("a") > 1)).select(*place), "hot")
        some_hot = not hot.isEmpty()
        small = keyed.join(hot, place, "left_anti") if some_hot else keyed
        x = small.where("chunk").select(*place, F.col("word").alias("x"))
        y = small.where("NOT chunk").select(*place, "grown", F.col("word").alias("y"))
        same_start = _cut(F.col("x"), F.lit(0), F.col("b")) == _cut(F.col("y"), F.lit(0), F.col("b"))
        first = (F.col("b") == F.col("length")) | ~same_start  # else a later stretch reports the pair
        both = x.join(y, place).where(((F.col("grown") == 1) | (F.col("x") < F.col("y"))) & first)
        both = both.where(F.levenshtein("x", "y", 1) == 1).select("x", "y")
        found = both if found is None else found.unionByName(both)
        if not some_hot:
            return found
        rows = _halves(keyed.join(hot, place, "left_semi").drop("key"))


def variants(words: DataFrame, bucket_pairs: int = BUCKET_PAIRS, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a table of ``word, n``."""
    words = materialise(words, "words")
    pairs = near_words(words, bucket_pairs)
    links = pairs.select(F.col("x").alias("word"), F.col("y").alias("other"))
    links = links.unionByName(pairs.select(F.col("y").alias("word"), F.col("x").alias("other")))
    other = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = links.join(other, "other").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    large = -F.col("best.n") >= ratio * F.col("n")
    formed = materialise(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(large, F.col("best.word")).alias("form"),
            F.when(large, -F.col("best.n")).alias("form_n"),
        ),
        "forms",
    )
    # counts grow ratio-fold along forms: a chain has at most log_ratio(largest n) steps
    most, longest = formed.agg(F.max("form_n")).first()[0] or 0, 0
    while most >= ratio:
        most, longest = most // ratio, longest + 1
    root = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    reach = 1
    while reach < longest:
        step = root.select(F.col("word").alias("root"), F.col("root").alias("next"))
        root = materialise(root.join(step, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        reach *= 2
    return formed.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
