"""Mixing documents to target weights with soft domain membership.

1. A classifier is trained on labelled documents (at most ``SAMPLE`` of them,
   those with the smallest hash): softmax regression on the hashed words and
   5-byte beginnings of words that are present, and a few dense features. It gives every document posteriors over the
   domains ``clean``, ``low`` (quality 0) and ``toxic``.
2. Document i has n_i tokens (words ``[^\\x20\\x09-\\x0D]+``) and posteriors
   p_i; with rates x the expected tokens of domain d are sum_i n_i p_id x_i.
   Projected-gradient least squares from x = 1 fits rates x >= 0 to the target
   totals T: x <- max(0, x - p_i . s), s = G^-1 (A x - T), G = sum_i n_i p_i p_i',
   the gradient in the metric where a document weighs as many tokens as it
   has, with step 1. A document's rate follows from its posteriors and the few
   vectors of the steps alone.
   That step never raises the loss, but crawls where most rows stand at a bound.
   So each step also tries directions with G taken over the rows that are free to
   move (plus ``DAMPING`` of the whole G), and the direction with the least loss
   is taken; all are measured in one aggregate. The fit ends when every domain is
   within ``REACHED`` of its target, or, where no rates reach the targets (a
   domain that every document has a little of can't get 0), when two steps in a
   row gain less than ``GAIN`` of the loss each: the least loss itself would put
   all tokens on the few documents with the least of that domain. There is no
   limit to the number of steps.
3. A rate becomes floor(rate + u) copies, u a uniform hash of the row and of its
   place in the written posteriors, so that the expected number of copies is the
   rate, and equal rows are drawn one by one.

Defined results: null and empty texts have no tokens and the posteriors of a
text without words; rows are weighed one by one, so null and repeated ids
count each; labels with a null (or without a document) are not used, of
several labels for an id the largest (toxic, quality) counts; without labelled
documents all posteriors are equal; a domain without tokens can't reach its
target; an empty table gives an empty result; columns of the documents pass
through, but for those named like an added column, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import bounded_batches, let, materialise
from .kernels import Powers, Words, is_word_byte_table, slices, string_parts, sums_before
from .licenses import word_table
from .token_counts import lower_ascii

DOMAINS = ("clean", "low", "toxic")
SAMPLE = 8000
BUCKET_BITS = 18
PREFIX = 5
DENSE = 6
MIN_DOCUMENTS, MIN_DEVIATION = 3, 4.0
EPOCHS, BATCH, RATE, DECAY = 12, 64, 1.0, 1e-4
DAMPING = (1e-1, 1e-3, 1e-5)
REACHED, ABSOLUTE, GAIN = 1e-3, 1e-6, 0.05
SYMBOLS = b"#*$%&|<>"
ADDED = ("n_tokens", *(f"p_{d}" for d in DOMAINS))


class Features:
    """Hashed words, and beginnings of words, present in a text, and dense
    features, for runs of texts."""

    def __init__(self):
        word = np.frombuffer(word_table(), np.uint8)
        self.inside, self.powers, self.lower = word != 32, Powers(), lower_ascii()
        self.not_white = is_word_byte_table()
        self.symbol = np.zeros(256, np.int64)
        self.symbol[np.frombuffer(SYMBOLS, np.uint8)] = 1
        self.upper = np.zeros(256, np.int64)
        self.upper[65:91] = 1

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(buckets, entries before each text, dense features, tokens)."""
        raw, off = string_parts(texts)
        w = Words(texts, self.powers, self.inside, self.lower)
        long, prefix = w.prefixes(PREFIX)
        owner = w.text_of_word()
        n_long = sums_before(np.bincount(owner[long], minlength=len(w.first) - 1))
        first = w.first + n_long  # words and prefixes of a text stand together
        bucket = np.empty(first[-1], np.int64)
        shift = np.uint64(64 - BUCKET_BITS)
        bucket[np.arange(len(w)) + n_long[owner]] = (w.key >> shift).astype(np.int64)
        bucket[np.arange(len(long)) + w.first[owner[long] + 1]] = (prefix >> shift).astype(np.int64)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            bucket[a:b].sort()
        new = np.ones(len(bucket), bool)
        new[1:] = bucket[1:] != bucket[:-1]
        new[first[:-1][first[:-1] < len(bucket)]] = True
        before = sums_before(new.astype(np.int64))[first]
        token = self.not_white[raw]
        begins = token.copy()
        begins[1:] &= ~token[:-1]
        edge = off[:-1][off[:-1] < len(raw)]
        begins[edge] = token[edge]
        span = lambda x: np.diff(sums_before(x)[off])  # noqa: E731  sums per text
        tokens, size = span(begins.astype(np.int64)), np.maximum(np.diff(off), 1)
        n = np.maximum(np.diff(w.first), 1)
        dense = np.stack(
            [
                span(self.symbol[raw]) / np.maximum(tokens, 1),
                span(self.upper[raw]) / size * 10,
                np.diff(before) / n,
                np.log1p(n) / 5,
                span(begins.astype(np.int64)) / size * 5,
                np.ones(len(n)),
            ],
            axis=1,
        )
        return bucket[new], before, dense, tokens


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def logits(model: dict[str, np.ndarray], bucket: np.ndarray, before: np.ndarray, dense: np.ndarray) -> np.ndarray:
    out = dense @ model["dense"]
    for d in range(len(DOMAINS)):
        out[:, d] += np.diff(sums_before(model["word"][bucket, d].astype(np.float64))[before])
    return out


def telling(bucket: np.ndarray, before: np.ndarray, domain: np.ndarray) -> np.ndarray:
    """For each bucket: does its number of documents in some domain differ from
    what the bucket's total lets expect, by at least ``MIN_DEVIATION`` standard
    deviations (and is it in ``MIN_DOCUMENTS`` documents at least)?"""
    size = 1 << BUCKET_BITS
    each = np.repeat(domain, np.diff(before))
    total = np.bincount(bucket, minlength=size)
    found = np.zeros(size, bool)
    for d in range(len(DOMAINS)):
        share = np.mean(domain == d) if len(domain) else 0.0
        seen = np.bincount(bucket[each == d], minlength=size)
        found |= np.abs(seen - total * share) >= MIN_DEVIATION * np.sqrt(total * share * (1 - share) + 1)
    return found & (total >= MIN_DOCUMENTS)


def train(bucket: np.ndarray, before: np.ndarray, dense: np.ndarray, domain: np.ndarray, seed: int = 5) -> dict[str, np.ndarray]:
    """Softmax regression by Adagrad with weight decay. Only words that are
    significantly more or less frequent in some domain get a weight: the others
    would only mark single texts."""
    k = len(DOMAINS)
    kept = telling(bucket, before, domain)[bucket]
    bucket, before = bucket[kept], sums_before(kept.astype(np.int64))[before]
    model = {"word": np.zeros((1 << BUCKET_BITS, k), np.float32), "dense": np.zeros((DENSE, k))}
    square = {"word": np.full((1 << BUCKET_BITS, k), 1e-2, np.float32), "dense": np.full((DENSE, k), 1e-2)}
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS if len(domain) else 0):
        order = rng.permutation(len(domain))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            parts = [bucket[before[i] : before[i + 1]] for i in pick]
            some = np.concatenate(parts)
            first = sums_before(np.array([len(x) for x in parts]))
            error = softmax(logits(model, some, first, dense[pick]))
            error[np.arange(len(pick)), domain[pick]] -= 1
            error /= len(pick)
            g = dense[pick].T @ error
            square["dense"] += g**2
            model["dense"] -= RATE * g / np.sqrt(square["dense"])
            own, inverse = np.unique(some, return_inverse=True)
            each = np.repeat(error, np.diff(first), axis=0)
            g = np.stack([np.bincount(inverse, weights=each[:, d], minlength=len(own)) for d in range(k)], axis=1).astype(np.float32)
            g += DECAY * model["word"][own]
            square["word"][own] += g**2
            model["word"][own] -= RATE * g / np.sqrt(square["word"][own])
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, n: int = SAMPLE, text: str = "text") -> DataFrame:
    """``text, domain`` of at most n labelled documents (one text per id)."""
    toxic, quality = F.max("toxic").alias("toxic"), F.max("quality").alias("quality")
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(toxic, quality)
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).otherwise(1).cast("long")
    own = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    some = known.join(own, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select("doc_id", domain.alias("domain"))
    texts = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(some), "doc_id")  # at most n rows
    return texts.groupBy("doc_id", "domain").agg(F.min("text").alias("text"))


def fit_classifier(docs: DataFrame, labels: DataFrame, n: int = SAMPLE, text: str = "text") -> dict[str, np.ndarray]:
    """The classifier. At most n documents reach the driver, each as the set of
    its hashed words (at most 2**18 numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            for part in slices(batch):
                bucket, before, dense, _ = features(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("domain"),
                        pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(bucket.astype(np.int32))),
                        pa.FixedSizeListArray.from_arrays(pa.array(dense.ravel()), DENSE).cast(pa.list_(pa.float64())),
                    ],
                    ["doc_id", "domain", "bucket", "dense"],
                )

    sample = labelled_sample(docs, labels, n, text).select("doc_id", "domain", "text")
    found = sample.mapInArrow(run, "doc_id long, domain long, bucket array<int>, dense array<double>").toArrow().sort_by("doc_id")
    if not found.num_rows:
        return train(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros((0, DENSE)), np.zeros(0, np.int64))
    lists = found.column("bucket").combine_chunks()
    before = sums_before(np.array([len(x) for x in lists], np.int64))
    dense = found.column("dense").combine_chunks().flatten().to_numpy().reshape(-1, DENSE)
    return train(lists.flatten().to_numpy().astype(np.int64), before, dense, found.column("domain").to_numpy())


def with_posteriors(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` and the posteriors ``p_<domain>``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # 2**18 buckets x 3 domains
    kept = [c for c in docs.columns if c.lower() not in ADDED]
    source = docs.select(F.struct(*kept).alias("row"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights = Features(), shared.value
        for batch in batches:
            for part in slices(batch):
                bucket, before, dense, tokens = features(part.column("text"))
                p = softmax(logits(weights, bucket, before, dense))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(tokens), *[pa.array(p[:, d]) for d in range(len(DOMAINS))]], ["row", *ADDED]
                )

    schema = StructType([source.schema["row"], StructField("n_tokens", LongType()), *[StructField(c, DoubleType()) for c in ADDED[1:]]])
    return source.mapInArrow(run, schema).select("row.*", *ADDED)


def vectors(values: Iterable[Iterable[float]]) -> Column:
    """A constant array of vectors. Rows meet it in lambdas, so that Spark's
    generated code is the same, and compiled once, for the values of all steps."""
    return F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in values])


def along(vector: Column, at: int = 0) -> Column:
    """The posteriors times the vector's entries from ``at`` on."""
    return sum((F.col(f"p_{d}") * vector[at + i] for i, d in enumerate(DOMAINS)), F.lit(0.0))


def moved(x: Column, step: Column, most: float) -> Column:
    """A row's rate after a step (the move's vector, then the gradient's): a row
    at a bound that the gradient pushes against stays."""
    move = F.when(held(x, along(step, len(DOMAINS)), most), 0.0).otherwise(along(step))
    return F.least(F.lit(most), F.greatest(F.lit(0.0), x - move))


def held(x: Column, gradient: Column, most: float) -> Column:
    return ((x <= 0) & (gradient > 0)) | ((x >= most) & (gradient < 0))


def rate(steps: list[list[float]], most: float = float("inf")) -> Column:
    """The rate of a row (at most ``most``) from its posteriors and the steps taken."""
    x = F.lit(1.0)
    if not steps:
        return x
    return F.aggregate(vectors(steps), x, lambda a, s: moved(a, s, most))


def totals(rows: DataFrame, steps: list[list[float]], most: float = float("inf")) -> np.ndarray:
    """Expected tokens of each domain at the rates of the steps."""
    return weighed(rows, rate(steps, most))


def weighed(rows: DataFrame, *rates: Column) -> np.ndarray:
    """Expected tokens of each domain, for one rate or (a row each) for several."""
    sums = [F.coalesce(F.sum(F.col("n_tokens") * r * F.col(f"p_{d}")), F.lit(0.0)) for r in rates for d in DOMAINS]
    found = np.array([float(v) for v in rows.agg(*sums).first()])
    return found if len(rates) == 1 else found.reshape(len(rates), -1)


def gram(rows: DataFrame, weight: Column) -> np.ndarray:
    """sum_i n_i w_i p_i p_i'."""
    p = [F.col(f"p_{d}") for d in DOMAINS]
    sums = [F.coalesce(F.sum(F.col("n_tokens") * weight * a * b), F.lit(0.0)) for a in p for b in p]
    return np.array([float(v) for v in rows.agg(*sums).first()]).reshape(len(DOMAINS), -1)


def fit_rates(rows: DataFrame, targets: np.ndarray, most: float = float("inf")) -> list[list[float]]:
    """Steps of projected-gradient least squares towards the target totals."""
    whole = gram(rows, F.lit(1.0))
    inverse = np.linalg.pinv(whole, rcond=1e-9, hermitian=True)
    loss_of = lambda r: float(r @ inverse @ r)
    steps: list[list[float]] = []
    slow = 0
    residual = totals(rows, steps, most) - targets
    while (np.abs(residual) > REACHED * targets + ABSOLUTE * targets.sum()).any():
        gradient = inverse @ residual
        now = rows.withColumn("x", rate(steps, most))
        free = gram(now.withColumn("w", let(vectors([gradient])[0], lambda g: F.when(held(F.col("x"), along(g), most), 0.0).otherwise(1.0))), F.col("w"))
        moves = [gradient, *(np.linalg.pinv(free + mu * whole, rcond=1e-12, hermitian=True) @ residual for mu in DAMPING)]
        tried = [[*map(float, m), *map(float, gradient)] for m in moves]
        placed = now.withColumn("y", F.transform(vectors(tried), lambda t: moved(F.col("x"), t, most)))
        found = weighed(placed, *[F.col("y")[i] for i in range(len(tried))]) - targets
        best = min(range(len(tried)), key=lambda i: loss_of(found[i]))
        before, after = loss_of(residual), loss_of(found[best])
        if after >= before:
            break
        steps.append(tried[best])
        residual = found[best]
        slow = slow + 1 if before - after <= GAIN * before else 0
        if slow == 2:
            break
    return steps


def target_totals(rows: DataFrame, shares: Mapping[str, float] | None = None, keep: Mapping[str, float] | None = None) -> np.ndarray:
    """Target tokens per domain: ``shares`` of the present total (they are
    scaled to sum to 1), or the present totals times ``keep``."""
    now = totals(rows, [])
    if shares is not None:
        w = np.array([shares[d] for d in DOMAINS], float)
        return now.sum() * w / w.sum()
    return now * np.array([(keep or {}).get(d, 1.0) for d in DOMAINS])


def kept_totals(rows: DataFrame, keep: Mapping[str, float]) -> np.ndarray:
    """Expected tokens per domain if each row is kept at its top domain's share
    ``keep`` (at most 1): what rows of other domains leak stays in the target."""
    top = F.greatest(*[F.col(f"p_{d}") for d in DOMAINS])
    share = F.lit(1.0)
    for d in reversed(DOMAINS):
        share = F.when(F.col(f"p_{d}") == top, F.lit(min(1.0, keep.get(d, 1.0)))).otherwise(share)
    return weighed(rows, share)


def copies(rate_: Column, *row: str) -> Column:
    """floor(rate + u), u uniform in [0, 1) from a hash of the row."""
    u = F.pmod(F.xxhash64(F.lit("copies"), *row), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return F.floor(rate_ + u).cast("long")


def mix(docs: DataFrame, labels: DataFrame, shares: Mapping[str, float], text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, p_<domain>, rate, copies`` of each row of ``docs``."""
    model = fit_classifier(docs, labels, text=text)
    source = docs.select("doc_id", F.col(text).alias("text"))
    numbered = with_posteriors(source, model).withColumn("row", F.monotonically_increasing_id()).drop("text")
    rows = materialise(numbered, "posteriors")
    steps = fit_rates(rows, target_totals(rows, shares=shares))
    placed = rows.withColumn("rate", rate(steps))
    return placed.withColumn("copies", copies(F.col("rate"), "doc_id", "row")).drop("row")


def thin(docs: DataFrame, labels: DataFrame, keep: Mapping[str, float], text: str = "text") -> DataFrame:
    """The rows of ``docs`` drawn at rates from 0 to 1, fitted to the domain
    totals of rows kept at their top domain's ``keep``; each at most once, with
    the columns of ``docs``. The judged rows are written once: the steps read
    the posteriors alone, the draw reads all."""
    model = fit_classifier(docs, labels, text=text)
    source = docs.select(F.struct("*").alias("whole"), F.col(text).alias("text"))
    judged = with_posteriors(source, model).select("whole", *ADDED, F.monotonically_increasing_id().alias("row"))
    rows = materialise(judged, "judged")
    steps = fit_rates(rows, kept_totals(rows, keep), most=1.0)
    return rows.where(copies(rate(steps, 1.0), "row", "whole.doc_id") >= 1).select("whole.*")
