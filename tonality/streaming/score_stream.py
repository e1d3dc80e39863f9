"""Continuous scoring of arriving texts with Structured Streaming.

Stateless: each micro-batch is cleaned, embedded and scored by the same
column expressions as the batch path. Append mode, no watermark (there is no
aggregation), a checkpoint per query so that a restart resumes where it
stopped and never writes a file twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.scoring import Encoder, drop_blank, score_texts
from ..schema import CONVERSATIONS

OUTPUT_COLUMNS = ["conv_id", "turn", "role", "processed_comment", "probability", "prediction", "sentiment"]


def text_stream(
    spark: SparkSession,
    directory: str,
    pattern: str | None = None,
    schema: StructType = CONVERSATIONS,
    max_files: int | None = None,
) -> DataFrame:
    """Streaming DataFrame over parquet files arriving in ``directory``
    (only names matching ``pattern`` if given). The schema is declared
    because streams cannot infer it."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(directory)


def scored_stream(model, stream: DataFrame, text_col: str = "text", encoder: Encoder | None = None) -> DataFrame:
    return score_texts(model, drop_blank(stream, text_col), text_col, encoder).select(*OUTPUT_COLUMNS)


def run_available(
    model,
    spark: SparkSession,
    directory: str,
    sink: str,
    checkpoint: str,
    pattern: str | None = None,
    text_col: str = "text",
    encoder: Encoder | None = None,
):
    """Process everything available now, then stop (``trigger(availableNow)``).

    Returns the finished query handle. Running it again with the same
    checkpoint adds only files that arrived since.
    """
    query = (
        scored_stream(model, text_stream(spark, directory, pattern), text_col, encoder)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
