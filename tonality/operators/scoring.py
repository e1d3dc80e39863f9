"""End-to-end scoring of free texts: clean -> tokenize -> embed -> predict -> decode.

One function serves batch and streaming input: it only adds columns, so it
works on a streaming DataFrame as well (no aggregation, no state).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import decode_label
from ..functions.text import clean_text, content_tokens, has_text
from .features import EMBED_DIM, hashed_vector
from .models import as_vector


#: An encoder takes the processed text (string column) and gives array<float|double>.
Encoder = Callable[[Column], Column]


def hashed_encoder(dim: int = EMBED_DIM) -> Encoder:
    """The default encoder: the hashed bag of the processed words."""
    return lambda text: hashed_vector(F.filter(F.split(text, " "), lambda w: w != F.lit("")), dim)


def embed_texts(df: DataFrame, text_col: str, encoder: Encoder | None = None, keep_text: bool = True) -> DataFrame:
    """Adds processed_comment, its embedding as an ML vector ``features`` and,
    with ``keep_text``, cleaned_comment. Without it the raw text goes too, so
    that rows kept for training hold no text."""
    out = df.withColumn("cleaned_comment", clean_text(F.col(text_col)))
    out = out.withColumn("processed_comment", F.array_join(content_tokens(F.col("cleaned_comment")), " "))
    out = out.withColumn("_embedding", (encoder or hashed_encoder())(F.col("processed_comment")))
    out = as_vector(out, "_embedding").drop("_embedding")
    return out if keep_text else out.drop("cleaned_comment", "processed_comment", text_col)


def score_texts(model, df: DataFrame, text_col: str = "text", encoder: Encoder | None = None) -> DataFrame:
    """Adds processed_comment, probability (array<double>, one per class),
    prediction (double) and sentiment (decoded)."""
    scored = model.transform(embed_texts(df, text_col, encoder))
    return scored.withColumns(
        {"probability": vector_to_array(F.col("probability")), "sentiment": decode_label(F.col("prediction"))}
    )


def drop_blank(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Skip blank input lines (null, or nothing but whitespace)."""
    return df.where(has_text(F.col(text_col)))
