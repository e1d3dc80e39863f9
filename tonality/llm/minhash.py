"""Near-duplicate documents: consistent weighted sampling over TF-IDF shingles.

A document is the multiset of its 5-word shingles, weighted tf * idf. Improved
consistent weighted sampling gives ``SAMPLES`` samples per document such that
two documents agree in a sample with a chance equal to their weighted Jaccard
similarity; ``BANDS`` bands of ``ROWS`` samples make the candidate buckets
(a pair at similarity 0.8 shares a bucket with a chance of 0.9998), and every
candidate pair that matters is verified on the whole texts.

* idf: document frequencies are counted over all documents in 2**18 hashed
  features (a table of fixed size, so it may be sent to the tasks); idf =
  1 + ln(N / df) / ln(2**18), between 1 and 2 at any corpus size.
* Equal texts are collapsed first; only representatives are compared.
* A bucket is resolved without listing its pairs: its members are compared
  with its smallest member, and links are merged to components. Where a bucket
  of three or more still holds several components, its members are dealt to
  blocks of bounded size, and each pair of blocks is compared as one matrix
  product; a task returns the connections it found, not the pairs. So each
  pair of documents sharing a bucket is verified or already in one component.
* Before the texts of a member and the smallest member meet, the two must agree
  in 36 of 64 samples' low bytes (expected 51 at similarity 0.8; missed with a
  chance near 1e-6).

Defined results: a text of one to four words has its whole word sequence as
its only shingle; a text without words is alone in its class; rows with a null
``doc_id`` are left out; rows that share a ``doc_id`` are one document with
several texts; a class is named by its smallest ``doc_id``; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialise, text_or_empty
from .components import components
from .kernels import Powers, Words, is_word_byte_table, key_runs, mix, runs_of, slices

SHINGLE_WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
SAMPLES = BANDS * ROWS
FEATURE_BITS = 18
MIN_AGREE = 36
POOL_BITS = 12
_SHINGLE = 0x8CB92BA72F3D8DD7
BLOCK = 1024
BLOCK_ROWS, BLOCK_BYTES = 512, 4_000_000
MATRIX_COLUMNS = 2048


class Shingler:
    """Distinct shingles of each text of a slice, with their counts."""

    def __init__(self):
        self.powers, self.inside = Powers(), is_word_byte_table()

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(shingle, count, number of entries before each text)."""
        w = Words(texts, self.powers, self.inside)
        key, before = runs_of(w.key, w.first, SHINGLE_WORDS, _SHINGLE)
        text = np.repeat(np.arange(len(before) - 1), np.diff(before))
        for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            key[a:b].sort()
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(key)))
        return key[head], count, np.searchsorted(text[head], np.arange(len(before)), "left")


def _feature(shingle: np.ndarray) -> np.ndarray:
    return (shingle >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler, total = Shingler(), np.zeros(1 << FEATURE_BITS, np.int64)
    held: list[np.ndarray] = []
    size = 0

    def add() -> None:
        if held:
            total[:] += np.bincount(np.concatenate(held), minlength=len(total))
            held.clear()

    for batch in batches:
        for part in slices(batch):
            shingle, _, before = shingler(part.column("text"))
            feature = _feature(shingle)  # ascending within a text, as the shingles are
            # a document counts once for a feature, also if two of its shingles share it
            new = np.ones(len(feature), bool)
            new[1:] = feature[1:] != feature[:-1]
            new[before[:-1][before[:-1] < len(feature)]] = True
            held.append(feature[new])
            size += len(feature)
            if size > 1 << 20:
                add()
                size = 0
    add()
    feature = np.flatnonzero(total)
    for at in range(0, len(feature), 1 << 16):
        f = feature[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(f.astype(np.int32)), pa.array(total[f])], ["feature", "n"])


def idf_table(docs: DataFrame, text: str = "text") -> np.ndarray:
    """idf of each of the 2**18 hashed features, over all documents."""
    source = docs.select(text_or_empty(text).alias("text"))
    counted = source.mapInArrow(_count_features, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # at most 2**18 rows
    df = np.zeros(1 << FEATURE_BITS)
    df[found.column("feature").to_numpy()] = found.column("n").to_numpy()
    n = max(1, docs.count())
    return (1 + np.log(n / np.clip(df, 1, n)) / np.log(1 << FEATURE_BITS)).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling with variates from a fixed pool.

    Shingles that share a row of the pool are told apart by their fingerprints
    (the smaller wins a tie), so the order stays consistent between documents.
    """

    def __init__(self):
        cell = np.arange(SAMPLES << POOL_BITS, dtype=np.uint64)

        def uniform(k: int) -> np.ndarray:
            x = mix(cell * np.uint64(8) + np.uint64(k + 1)) >> np.uint64(40)
            return (x.astype(np.float32) + np.float32(0.5)) / np.float32(1 << 24)

        gamma = lambda k: -np.log(uniform(k) * uniform(k + 1))  # noqa: E731  shape 2, scale 1
        r, log_c, beta = gamma(0), np.log(gamma(2)), uniform(4)
        self.pool = np.concatenate([x.reshape(-1, SAMPLES) for x in (r, beta, log_c)], axis=1)

    def __call__(self, shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """The samples of one document (shingles ascending), as fingerprints."""
        best = np.full(SAMPLES, np.inf, np.float32)
        which, level = np.zeros(SAMPLES, np.int64), np.zeros(SAMPLES, np.float32)
        column = np.arange(SAMPLES)
        log_w = np.log(weight.astype(np.float32))[:, None]
        row = (shingle & np.uint64((1 << POOL_BITS) - 1)).astype(np.int64)
        for at in range(0, len(shingle), BLOCK):
            v = self.pool.take(row[at : at + BLOCK], axis=0)
            r, beta, log_c = v[:, :SAMPLES], v[:, SAMPLES : 2 * SAMPLES], v[:, 2 * SAMPLES :]
            t = log_w[at : at + BLOCK] / r
            t += beta
            np.floor(t, out=t)
            log_a = t - beta  # log a = log c - r (t - beta) - r
            log_a += 1
            log_a *= r
            np.subtract(log_c, log_a, out=log_a)
            least = log_a.argmin(axis=0)
            value = log_a[least, column]
            better = value < best
            best = np.where(better, value, best)
            which = np.where(better, at + least, which)
            level = np.where(better, t[least, column], level)
        step = np.uint64(0x9E3779B97F4A7C15) * (level.astype(np.int64).view(np.uint64) + np.uint64(1))
        return mix(shingle[which] + step)


def bands_of(samples: np.ndarray) -> np.ndarray:
    """Bucket keys: one 64-bit number per band, the band's number included."""
    rows = samples.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix(key * np.uint64(_SHINGLE) + rows[:, k])
    return key


SIGNATURE_SCHEMA = "doc_id long, key1 long, key2 long, bands array<long>, low binary"


def _signatures(idf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sampler, weights = Shingler(), Sampler(), idf.value
        for batch in batches:
            for part in slices(batch):
                shingle, count, before = shingler(part.column("text"))
                weight = count * weights[_feature(shingle)]
                bands, low = [], []
                for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
                    if a == b:
                        bands.append(None)
                        low.append(None)
                        continue
                    samples = sampler(shingle[a:b], weight[a:b])
                    bands.append(bands_of(samples).view(np.int64))
                    low.append((samples & np.uint64(255)).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("key1"),
                        part.column("key2"),
                        pa.array(bands, pa.list_(pa.int64())),
                        pa.array(low, pa.binary()),
                    ],
                    ["doc_id", "key1", "key2", "bands", "low"],
                )

    return run


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SAMPLES) for c in ("low_a", "low_b"))
            keep = pa.array((a == b).sum(axis=1) >= MIN_AGREE)
            yield batch.select(["a", "b"]).filter(keep)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of minima over sum of maxima of two (sorted shingles, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = np.minimum(a[1][i], b[1][j]).sum()
    every = a[1].sum() + b[1].sum() - common
    return float(common / every) if every > 0 else 0.0


def _verify(idf, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, weights = Shingler(), idf.value
        for batch in batches:
            for part in slices(batch, "text_a"):
                for part_b in slices(part, "text_b"):
                    sides = []
                    for c in ("text_a", "text_b"):
                        shingle, count, before = shingler(part_b.column(c))
                        weight = (count * weights[_feature(shingle)]).astype(np.float64)
                        sides.append((shingle, weight, before))
                    sims = []
                    for i in range(part_b.num_rows):
                        x, y = ((s[p[i] : p[i + 1]], w[p[i] : p[i + 1]]) for s, w, p in sides)
                        sims.append(weighted_jaccard(x, y))
                    sim = np.array(sims)
                    rows = part_b.select(["a", "b"]).append_column("similarity", pa.array(sim, pa.float64()))
                    yield rows.filter(pa.array(sim >= threshold))

    return run


def _verified(pairs: DataFrame, lows: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""
    named = lambda t, c, k: t.select(F.col("doc_id").alias(k), F.col(c).alias(f"{c}_{k}"))
    both = pairs.join(named(lows, "low", "a").hint("merge"), "a").join(named(lows, "low", "b").hint("merge"), "b")
    likely = materialise(both.select("a", "b", "low_a", "low_b").mapInArrow(_agree, "a long, b long").distinct(), "likely")
    full = likely.join(named(texts, "text", "a").hint("merge"), "a").join(named(texts, "text", "b").hint("merge"), "b")
    checked = full.select("a", "b", "text_a", "text_b").mapInArrow(_verify(idf, threshold), "a long, b long, similarity double")
    return materialise(checked, "verified")


def elements(shingle: np.ndarray, count: np.ndarray, before: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The multisets as weighted sets: a shingle that occurs c times gives c
    elements of weight idf. (element, weight, text)."""
    text = np.repeat(np.repeat(np.arange(len(before) - 1), np.diff(before)), count)
    each = np.repeat(shingle, count)
    nth = (np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint64)
    weight = idf[_feature(each)].astype(np.float64)
    return np.where(nth > 0, mix(each + nth * np.uint64(_SHINGLE)), each), weight, text


def similarities(element: np.ndarray, weight: np.ndarray, text: np.ndarray, n: int, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of the texts ``rows`` with ``columns``."""
    total = np.bincount(text, weights=weight, minlength=n)
    _, place, times = np.unique(element, return_inverse=True, return_counts=True)
    shared = times[place] > 1
    place, weight, text = np.unique(place[shared], return_inverse=True)[1], weight[shared], text[shared]
    common = np.zeros((len(rows), len(columns)))
    order = np.argsort(place, kind="stable")
    place, weight, text = place[order], weight[order], text[order]
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, MATRIX_COLUMNS):
        a, b = np.searchsorted(place, (at, at + MATRIX_COLUMNS))
        dense = np.zeros((n, MATRIX_COLUMNS))
        dense[text[a:b], place[a:b] - at] = np.sqrt(weight[a:b])
        common += dense[rows] @ dense[columns].T
    union = total[rows][:, None] + total[columns][None, :] - common
    return np.divide(common, union, out=np.zeros_like(common), where=union > 0)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node connected to it by pairs (i, j)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare_blocks(idf, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, weights = Shingler(), idf.value
        for rows in key_runs(batches, ["band", "low", "high"]):
            rows = rows.sort_by("doc_id")
            node, own = rows.column("doc_id").to_numpy(), rows.column("own").to_numpy()
            low, high = (np.flatnonzero(own == rows.column(c)[0].as_py()) for c in ("low", "high"))
            if not len(low) or not len(high):
                continue
            element, weight, text = elements(*shingler(rows.column("text").combine_chunks()), weights)
            i, j = np.nonzero(similarities(element, weight, text, len(node), low, high) >= threshold)
            least = forest(len(node), low[i], high[j])
            linked = np.flatnonzero(node[least] != node)
            yield pa.RecordBatch.from_arrays([pa.array(node[least[linked]]), pa.array(node[linked])], ["a", "b"])

    return run


def _open_links(shared: DataFrame, part: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Connections inside buckets that hold several components."""
    placed = shared.select("band", "doc_id").join(part.withColumnRenamed("node", "doc_id").hint("merge"), "doc_id", "left")
    placed = materialise(placed.select("band", "doc_id", F.coalesce("component", "doc_id").alias("part")), "placed")
    size = texts.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("bytes"))
    open_ = (
        placed.join(size.hint("merge"), "doc_id")
        .groupBy("band")
        .agg((F.min("part") != F.max("part")).alias("apart"), F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
        .where("apart AND n > 2")  # of two members the pair is done
        .select("band", F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("long").alias("blocks"))
    )
    open_ = materialise(open_, "open")
    dealt = placed.select("band", "doc_id").join(open_, "band").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    keyed = met.select("band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "doc_id")
    grouped = keyed.join(texts.hint("merge"), "doc_id").repartition("band", "low", "high").sortWithinPartitions("band", "low", "high")
    found = grouped.select("band", "low", "high", "own", "doc_id", "text").mapInArrow(_compare_blocks(idf, threshold), "a long, b long")
    return materialise(found, "connected")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(classes, links). ``classes``: ``doc_id, copy_of, class_id`` for each
    distinct id, where ``copy_of`` is the smallest id with an equal text and
    ``class_id`` the smallest id connected by links. ``links``: ``a, b``, pairs
    of representatives connected by links, enough to connect each class.

    Tables that grow with the corpus are joined by merging, never broadcast."""
    spark = docs.sparkSession
    bounded_batches(spark)
    idf = spark.sparkContext.broadcast(idf_table(docs, text))
    t = text_or_empty(text)
    source = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(t).alias("key1"),
        F.xxhash64(F.lit(1), t).alias("key2"),
        t.alias("text"),
    ).where("doc_id IS NOT NULL")
    signed = materialise(source.mapInArrow(_signatures(idf), SIGNATURE_SCHEMA), "signatures")

    with_words = signed.where("bands IS NOT NULL")
    first = materialise(with_words.groupBy("key1", "key2").agg(F.min("doc_id").alias("copy_of")), "first")
    member = materialise(with_words.join(first.hint("merge"), ["key1", "key2"]), "member")
    own = member.where("doc_id = copy_of")
    member = member.select("doc_id", "copy_of").distinct()
    band = materialise(own.select(F.explode("bands").alias("band"), "doc_id").distinct(), "bands")

    lead = band.groupBy("band").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last")).where("a < last").drop("last")
    shared = materialise(band.join(materialise(lead, "lead").hint("merge"), "band"), "shared")
    concerned = materialise(shared.select("doc_id").distinct(), "concerned").hint("merge")
    low = materialise(own.select("doc_id", "low").join(concerned, "doc_id").distinct(), "low")
    texts = materialise(source.select("doc_id", "text").join(concerned, "doc_id").distinct(), "texts")

    pairs = shared.where("doc_id > a").select("a", F.col("doc_id").alias("b")).distinct()
    links = _verified(pairs, low, texts, idf, threshold).select("a", "b")
    links = links.unionByName(_open_links(shared, components(links), texts, idf, threshold))
    idf.destroy()  # all that used it is written

    # an id with several texts connects their classes
    several = member.groupBy("doc_id").agg(F.min("copy_of").alias("a"), F.max("copy_of").alias("last")).where("a < last")
    same_id = member.join(several, "doc_id").select("a", F.col("copy_of").alias("b"))
    final = components(links.unionByName(same_id))
    joined = member.join(final.withColumnRenamed("node", "copy_of"), "copy_of", "left")
    placed = joined.select("doc_id", "copy_of", F.coalesce("component", "copy_of").alias("class_id"))
    alone = signed.where("bands IS NULL").select("doc_id").distinct().join(member.select("doc_id"), "doc_id", "left_anti")
    classes = placed.groupBy("doc_id").agg(F.min("copy_of").alias("copy_of"), F.min("class_id").alias("class_id"))
    return classes.unionByName(alone.select("doc_id", F.col("doc_id").alias("copy_of"), F.col("doc_id").alias("class_id"))), links


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document leads its class, and rows without an
    id; rows that share a ``doc_id`` stay or go together."""
    classes, _ = near_duplicates(docs, threshold, text)
    gone = classes.where("doc_id <> class_id").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
