"""The report tables behind the charts, built and written as DataFrames.

Only these small tables are written (one file each); the scored rows they
summarise stay where they are. The rows are read twice: once for all class
reports, once for the sample, which is materialised and serves every chart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import decode_label
from ..functions.preview import hover_2d, hover_3d, preview_2d, preview_3d
from ..functions.text import preview_source
from ..sources.sinks import cut_lineage, write_report
from . import evaluate, projection
from .split import exact_sample


def build_reports(
    scored: DataFrame,
    id_col: str,
    label_col: str = "label",
    prediction_col: str = "prediction",
    text_col: str | None = "processed_comment",
    sample_n: int = 3000,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """Distribution, confusion matrix and accuracy over all scored rows; if the
    rows carry x, y, z, also the sample's points, class counts, planar
    projections and embedding report, and its 2-D and 3-D hover texts."""
    spark = scored.sparkSession
    counts = cut_lineage(spark, evaluate.summary_counts(scored, label_col, prediction_col), "summary")
    out = evaluate.class_reports(counts)
    if {"x", "y", "z"} <= set(scored.columns):
        columns = [id_col, label_col, prediction_col, *([text_col] if text_col else []), "x", "y", "z"]
        sample = exact_sample(scored.select(*dict.fromkeys(columns)), id_col, sample_n, seed)
        sample = cut_lineage(spark, sample.withColumn("sentiment", decode_label(F.col(prediction_col))), "report-sample")
        out["sample_class_counts"] = evaluate.value_counts(sample, "sentiment")
        out["points_3d"] = sample.select(id_col, "sentiment", "x", "y", "z")
        out["planar_projection"] = projection.planar(sample, id_col, prediction_col)
        out["embedding_report"] = projection.embedding_report(sample, prediction_col)
        if text_col:
            pred, true, source = F.col("sentiment"), decode_label(F.col(label_col)), preview_source(F.col(text_col))
            out["hover_2d"] = sample.select(id_col, hover_2d(pred, preview_2d(source), true).alias("hover"))
            axes = [F.col(a) for a in "xyz"]
            sized = evaluate.with_class_size(sample, "sentiment")
            out["hover_3d"] = sized.select(id_col, hover_3d(pred, F.col("class_size"), preview_3d(source), true, *axes).alias("hover"))
    return out


def write_reports(reports: dict[str, DataFrame], base_path: str, fmt: str = "json") -> list[str]:
    paths = []
    for name, df in reports.items():
        path = f"{base_path.rstrip('/')}/{name}"
        write_report(df, path, fmt)
        paths.append(path)
    return paths
