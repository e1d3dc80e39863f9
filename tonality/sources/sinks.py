"""Sinks: parquet tables, report tables and Spark ML models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LogisticRegressionModel,
    NaiveBayesModel,
    RandomForestClassificationModel,
)
from pyspark.sql import DataFrame, SparkSession

MODEL_KINDS = {
    "logreg": LogisticRegressionModel,
    "forest": RandomForestClassificationModel,
    "bayes": NaiveBayesModel,
    "pipeline": PipelineModel,
}


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a parquet table, optionally partitioned (e.g. by split)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_comments_csv(df: DataFrame, path: str) -> None:
    """Comments as RFC-4180 CSV with a header: fields with a quote, comma or
    line break are quoted and quotes doubled, and surrounding whitespace is
    kept (Spark's CSV writer trims it by default). ``read_comments_csv(...,
    mode="strict")`` reads it back unchanged."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Report tables are tiny; one file each keeps them easy to pick up."""
    df.coalesce(1).write.mode("overwrite").format(fmt).save(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind: str = "logreg"):
    return MODEL_KINDS[kind].load(path)


def cut_lineage(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` as parquet in the shared folder and read it back.

    This survives executor loss (unlike a local checkpoint) and gives later
    stages a short plan.
    """
    from ..session import scratch_path

    path = scratch_path(spark, name)
    write_parquet(df, path)
    return spark.read.parquet(path)
