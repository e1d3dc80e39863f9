"""Class label encoding and decoding as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import CLASSES, UNKNOWN_CLASS

# --- fixed values: sentiment strings that map to a class -------------------
# Exact, case-sensitive match; every other value (null, "Positive",
# "negative", typos, broken CSV rows) becomes class 0.
POSITIVE_TEXT = "positive"
NEUTRAL_TEXT = "neutral"
# ---------------------------------------------------------------------------


def encode_label(sentiment: Column) -> Column:
    """positive -> 2, neutral -> 1, anything else (null included) -> 0."""
    return (
        F.when(sentiment == F.lit(POSITIVE_TEXT), F.lit(2))
        .when(sentiment == F.lit(NEUTRAL_TEXT), F.lit(1))
        .otherwise(F.lit(0))
        .cast("int")
    )


def _decode(value: Column, field: int, default) -> Column:
    expr = None
    for row in CLASSES:
        hit = value == F.lit(row[0])
        expr = F.when(hit, F.lit(row[field])) if expr is None else expr.when(hit, F.lit(row[field]))
    return expr.otherwise(F.lit(default))


def decode_label(value: Column) -> Column:
    """0/1/2 (int or double) -> Negative/Neutral/Positive, else Unknown."""
    return _decode(value, 1, UNKNOWN_CLASS[0])


def decode_emoji(value: Column) -> Column:
    return _decode(value, 2, UNKNOWN_CLASS[1])


def decode_style(value: Column) -> Column:
    return _decode(value, 3, UNKNOWN_CLASS[2])


def decode_color(value: Column) -> Column:
    return _decode(value, 4, UNKNOWN_CLASS[3])


def sentiment_from_flags(toxic: Column, quality: Column) -> Column:
    """Stand-in for the raw ``Sentiment`` column on the test tables:
    toxic -> negative, else quality -> positive, else neutral."""
    return (
        F.when(toxic == F.lit(1), F.lit("negative"))
        .when(quality == F.lit(1), F.lit(POSITIVE_TEXT))
        .otherwise(F.lit(NEUTRAL_TEXT))
    )


# ---- SQL text (DuckDB dialect) -------------------------------------------


def sql_encode_label(expr: str) -> str:
    return (
        f"CAST(CASE WHEN {expr} = '{POSITIVE_TEXT}' THEN 2 "
        f"WHEN {expr} = '{NEUTRAL_TEXT}' THEN 1 ELSE 0 END AS INTEGER)"
    )


def sql_decode(expr: str, field: int = 1) -> str:
    default = UNKNOWN_CLASS[field - 1]
    whens = " ".join(f"WHEN {expr} = {row[0]} THEN '{row[field]}'" for row in CLASSES)
    tail = "NULL" if default is None else f"'{default}'"
    return f"CASE {whens} ELSE {tail} END"


def sql_sentiment_from_flags(toxic: str = "toxic", quality: str = "quality") -> str:
    return (
        f"CASE WHEN {toxic} = 1 THEN 'negative' WHEN {quality} = 1 "
        f"THEN '{POSITIVE_TEXT}' ELSE '{NEUTRAL_TEXT}' END"
    )
