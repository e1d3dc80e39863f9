"""Naive Bayes that grows with its data: sufficient statistics in a versioned table.

A model depends on its training rows only through counts: per class the number
of documents, per term and class the occurrences and the documents with the
term. Counts add up, so a new batch is counted by itself and merged with the
last version; old texts are not read again, and batches counted on different
clusters can be merged in any order.

Layout: ``<path>/v<N>/{terms,classes,batches}``, each written whole, and
``<path>/v<N>/committed`` last. A version without it doesn't exist: a job that
dies half-way leaves the version before. A batch has an id; merging an id that
is in the version already changes nothing, so a restarted job adds nothing
twice. One writer at a time.

Defined results: labels must be whole, non-negative numbers; a batch without
rows makes a version like the one before, but for the list of its batches; a
document without words counts as the empty term, as in ``naive_bayes.fit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import ml_tokens
from .features import DEFAULT_VOCAB_SIZE, term_counts
from .naive_bayes import NaiveBayesTables, class_totals, model_of

TERMS = "term string, label long, tf long, df long"
CLASSES = "label long, n long"
BATCHES = "batch string, n long"


def statistics(train: DataFrame, text_col: str = "processed_comment", label_col: str = "label") -> tuple[DataFrame, DataFrame]:
    """(terms, classes) of the rows: ``term, label, tf, df`` and ``label, n``."""
    label = F.col(label_col).cast("long").alias("label")
    rows = train.select(label, F.inline(term_counts(ml_tokens(F.col(text_col)))))
    terms = rows.groupBy("term", "label").agg(F.sum("tf").cast("long").alias("tf"), F.count(F.lit(1)).alias("df"))
    return terms, train.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def merged(a: tuple[DataFrame, DataFrame], b: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The statistics of the rows of both: partial sums, then one shuffle by term."""
    terms = a[0].unionByName(b[0]).groupBy("term", "label").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    return terms, a[1].unionByName(b[1]).groupBy("label").agg(F.sum("n").alias("n"))


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions, in order."""
    glob = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/v*/committed/_SUCCESS")
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob)
    return sorted(int(s.getPath().getParent().getParent().getName()[1:]) for s in found or [])


def _read(spark: SparkSession, path: str, version: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    if not version:
        return tuple(spark.createDataFrame([], s) for s in (TERMS, CLASSES, BATCHES))
    base = f"{path.rstrip('/')}/v{version}"
    return tuple(spark.read.schema(s).parquet(f"{base}/{n}") for n, s in (("terms", TERMS), ("classes", CLASSES), ("batches", BATCHES)))


def update(spark: SparkSession, path: str, batch: DataFrame, batch_id: str, text_col: str = "processed_comment", label_col: str = "label") -> int:
    """Add a batch of training rows; returns the version that has it."""
    version = max(versions(spark, path), default=0)
    terms, classes, batches = _read(spark, path, version)
    if batches.where(F.col("batch") == batch_id).take(1):
        return version
    class_totals(batch, label_col)  # refuses labels that aren't classes
    terms, classes = merged((terms, classes), statistics(batch, text_col, label_col))
    known = batches.unionByName(batch.agg(F.lit(batch_id).alias("batch"), F.count(F.lit(1)).alias("n")))
    base = f"{path.rstrip('/')}/v{version + 1}"
    for name, df in (("terms", terms), ("classes", classes), ("batches", known.coalesce(1))):
        df.write.mode("overwrite").parquet(f"{base}/{name}")
    spark.range(1).select(F.lit(version + 1).alias("version")).coalesce(1).write.mode("overwrite").parquet(f"{base}/committed")
    return version + 1


def fit_stored(
    spark: SparkSession, path: str, version: int | None = None, vocab_size: int = DEFAULT_VOCAB_SIZE, smoothing: float = 1.0
) -> NaiveBayesTables:
    """The model of a version (the last, if none is named): what
    ``naive_bayes.fit`` gives on all rows of its batches."""
    known = versions(spark, path)
    version = version or max(known, default=0)
    if version not in known:
        raise ValueError(f"no committed version {version} under {path}; there are {known}")
    terms, classes, _ = _read(spark, path, version)
    totals = {r["label"]: r["n"] for r in classes.orderBy("label").collect()}  # one row per class
    stats = terms.groupBy("term").agg(
        F.sum("tf").alias("n"),
        F.sum("df").alias("df"),
        *[F.sum(F.when(F.col("label") == c, F.col("tf")).otherwise(F.lit(0))).alias(f"tf_{c}") for c in totals],
    )
    return model_of(stats, totals, vocab_size, smoothing)
