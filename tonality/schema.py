"""Declared schemas of raw comments and stream input, and the class dimension."""

from __future__ import annotations

from pyspark.sql import types as T

# R1: raw comments as they arrive in CSV.
RAW_COMMENTS = T.StructType(
    [
        T.StructField("Comment", T.StringType(), True),
        T.StructField("Sentiment", T.StringType(), True),
    ]
)

# R1 read in strict mode keeps malformed records aside in this column.
CORRUPT_COLUMN = "_corrupt_record"
RAW_COMMENTS_STRICT = T.StructType(
    RAW_COMMENTS.fields + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

# Stream input (conversations table shape).
CONVERSATIONS = T.StructType(
    [
        T.StructField("conv_id", T.LongType(), True),
        T.StructField("turn", T.LongType(), True),
        T.StructField("role", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)

# --- fixed values: the class dimension -------------------------------------
# label, name, emoji, console style, chart colour, position in the
# distribution chart (Positive, Neutral, Negative).
CLASSES = [
    (0, "Negative", "😡", "bold red", "#DC143C", 3),
    (1, "Neutral", "😐", "bold yellow", "#4169E1", 2),
    (2, "Positive", "😃", "bold green", "#2E8B57", 1),
]
UNKNOWN_CLASS = ("Unknown", "❓", "bold white", None)
# ---------------------------------------------------------------------------
