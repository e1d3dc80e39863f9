"""Sources: raw comments from CSV or parquet, and the stand-in test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import sentiment_from_flags
from ..schema import CORRUPT_COLUMN, RAW_COMMENTS, RAW_COMMENTS_STRICT
from .strict_csv import STRICT_OPTIONS, read_strict_splits

CSV_MODES = ("compat", "strict", "splits")


def read_comments_csv(spark: SparkSession, path: str, mode: str = "compat") -> DataFrame:
    """Raw comments (``Comment``, ``Sentiment``) from CSV with a header.

    The schema is declared, which saves the inference pass over the file.

    * ``compat``: default quote/escape and no multi-line records, which is how
      the original pipeline read its file: a quoted newline splits a record in
      two and a doubled quote shifts the columns.
    * ``strict``: RFC-4180 records (``multiLine``, ``""`` escapes). Records that
      still do not parse are kept aside in ``_corrupt_record`` rather than
      silently turned into label 0; use :func:`split_corrupt` to separate them.
      A file is one task.
    * ``splits``: the same records, read in splits (``strict_csv``): for large files.
    """
    if mode not in CSV_MODES:
        raise ValueError(f"mode must be one of {CSV_MODES}, got {mode!r}")
    if mode == "splits":
        return read_strict_splits(spark, path, RAW_COMMENTS_STRICT, CORRUPT_COLUMN)
    reader = spark.read.option("header", True)
    if mode == "compat":
        return reader.schema(RAW_COMMENTS).csv(path)
    return (
        reader.schema(RAW_COMMENTS_STRICT)
        .options(**STRICT_OPTIONS)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .csv(path)
    )


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows) of a strict read. Cache ``df`` first if both are used:
    Spark forbids queries that touch only the corrupt-record column of a raw scan."""
    good = df.where(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    bad = df.where(F.col(CORRUPT_COLUMN).isNotNull())
    return good, bad


def schema_preview(df: DataFrame, n: int = 5, order_by: str | None = None):
    """The schema tree and the first ``n`` rows (in a stated order if given)."""
    rows = df.orderBy(order_by) if order_by else df
    return df.schema.treeString(), rows.limit(n)


# ---- stand-in tables --------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, Comment, Sentiment`` for documents that have labels.

    Both sides grow with the data, so this is a shuffle join on ``doc_id``
    (AQE may still switch it to a broadcast at run time when one side is
    small); only the three needed columns of each side are read.
    """
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("Comment")
    )
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", sentiment_from_flags(F.col("toxic"), F.col("quality")).alias("Sentiment")
    )
    return docs.join(labels, "doc_id", "inner")


def conversation_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
