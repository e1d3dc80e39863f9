"""Preprocessing: raw comments -> cleaned text, processed text, integer label.

All derived columns are native expressions, so the whole step runs inside the
scan's stage with no Python worker and no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import encode_label
from ..functions.text import clean_text, process_text


def preprocess(
    df: DataFrame,
    text_col: str = "Comment",
    sentiment_col: str | None = "Sentiment",
    stop_words=None,
) -> DataFrame:
    """Add ``cleaned_comment``, ``processed_comment`` and (if a sentiment
    column is given) ``label``."""
    # Two projections: the second reads the cleaned text as a column. Spark
    # does not merge them where both columns are used (the cleaning would run
    # twice), and drops or merges the first where only one is.
    out = df.withColumn("cleaned_comment", clean_text(F.col(text_col)))
    out = out.withColumn("processed_comment", process_text(F.col("cleaned_comment"), stop_words))
    if sentiment_col is not None:
        out = out.withColumn("label", encode_label(F.col(sentiment_col)))
    return out
