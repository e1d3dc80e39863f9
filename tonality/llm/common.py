"""Helpers shared by the operators: tables, materialised steps, word columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: The white space that separates words: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back
    (``session.remove_scratch`` deletes all such tables of an application).

    Cuts the lineage, survives lost executors, and gives each later reader the
    same rows (also where a column is a generated row number).
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array."""
    return F.array_remove(F.split(F.translate(text, WHITE[1:], " " * 5), " "), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the
    body mentions it (a lambda variable is bound, not inlined)."""
    return F.transform(F.array(value), body)[0]


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns (of any letter case) that an operator is about to
    add, so that inputs with clashing extra columns don't give ambiguous names."""
    taken = {n.lower() for n in names}
    return df.select(*[c for c in df.columns if c.lower() not in taken])


def bounded_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches sent to Python small in bytes, whatever the
    texts' lengths (a single longer row is a batch of its own)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
