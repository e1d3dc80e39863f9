"""The stages as Spark jobs: preprocess, train, predict, report, grid search,
and scoring of new texts (batch and stream) with a saved model.

Each stage reads what an earlier one wrote (parquet, Spark ML models) and
writes its own output, so stages can run as separate applications. Paths are
arguments; on a cluster they point to shared storage.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import evaluate, models, projection
from .operators.preprocess import preprocess
from .operators.report import build_reports, write_reports
from .operators.scoring import Encoder, drop_blank, hashed_encoder, score_texts
from .operators.split import train_test_split
from .schema import CORRUPT_COLUMN
from .sources.comments import read_comments_csv
from .sources.sinks import load_model, save_model, write_parquet, write_report
from .streaming.score_stream import run_available

ROW_ID = "row_id"
CONTENT_ID = "content_id"


def preprocess_job(spark: SparkSession, csv_path: str, out_path: str, mode: str = "compat") -> DataFrame:
    """CSV -> processed comments (R2) with ``row_id``, a number given here and
    stored, different for every row, and ``content_id``, a hash of the comment
    and its sentiment that copies share.

    In the modes strict and splits the rows are written once, partitioned by whether they
    parse: good rows are the ones under ``rejected=false``, which is what this
    returns and the next stage reads; the others stay beside them, with the
    record as it was, instead of becoming label-0 rows.
    """
    raw = read_comments_csv(spark, csv_path, mode)
    content = F.xxhash64(F.coalesce("Comment", F.lit("")), F.coalesce("Sentiment", F.lit("")))
    processed = preprocess(raw.withColumns({ROW_ID: F.monotonically_increasing_id(), CONTENT_ID: content}))
    if mode != "compat":
        flagged = processed.withColumn("rejected", F.col(CORRUPT_COLUMN).isNotNull())
        write_parquet(flagged, out_path, ["rejected"])
    else:
        write_parquet(processed, out_path)
    return read_processed(spark, out_path)


def read_processed(spark: SparkSession, path: str) -> DataFrame:
    """The usable rows of a preprocess output, of either mode."""
    rows = spark.read.parquet(path)
    if "rejected" in rows.columns:
        rows = rows.where(~F.col("rejected").cast("boolean")).drop("rejected", CORRUPT_COLUMN)
    return rows


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The records of a strict preprocess output that did not parse."""
    rows = spark.read.parquet(path)
    if "rejected" not in rows.columns:
        return rows.limit(0)
    return rows.where(F.col("rejected").cast("boolean")).select(CORRUPT_COLUMN)


def featurize(df: DataFrame, encoder: Encoder | None = None) -> DataFrame:
    """processed_comment -> ``embedding`` (array) and ML vector ``features``."""
    return models.as_vector(df.withColumn("embedding", (encoder or hashed_encoder())(F.col("processed_comment"))), "embedding")


def _featured(spark: SparkSession, processed_path: str, encoder: Encoder | None) -> DataFrame:
    return featurize(read_processed(spark, processed_path).select(ROW_ID, CONTENT_ID, "processed_comment", "label"), encoder)


def train_job(
    spark: SparkSession,
    processed_path: str,
    model_dir: str,
    test_path: str,
    train_pct: int = 80,
    seed: int = 42,
    encoder: Encoder | None = None,
    split_by: str = ROW_ID,
) -> dict:
    """Embed, split, fit logistic regression and random forest, save both and
    the test rows (R4).

    ``split_by=row_id`` deals every row on its own, so the shares hold whatever
    the comments. ``split_by=content_id`` keeps copies of a comment on one side,
    so the shares shift when a comment has very many copies.
    """
    if split_by not in (ROW_ID, CONTENT_ID):
        raise ValueError(f"split_by must be {ROW_ID!r} or {CONTENT_ID!r}, got {split_by!r}")
    train, test = train_test_split(_featured(spark, processed_path, encoder), split_by, train_pct, seed)
    with models.persisted(train.select("label", "features")) as rows:
        lr = models.train_logreg(rows)
        rf = models.train_forest(rows, seed=seed)
    save_model(lr, f"{model_dir.rstrip('/')}/logreg")
    save_model(rf, f"{model_dir.rstrip('/')}/forest")
    write_parquet(test.select(ROW_ID, "processed_comment", "label", "embedding"), test_path)
    return {"logreg": lr, "forest": rf}


def grid_job(
    spark: SparkSession,
    processed_path: str,
    out_dir: str,
    train_pct: int = 80,
    seed: int = 42,
    encoder: Encoder | None = None,
    grid: dict | None = None,
) -> DataFrame:
    """Grid search over the training rows: writes the ranked sets, the best set
    with its test accuracy, and the best model; returns the summary row."""
    train, test = train_test_split(_featured(spark, processed_path, encoder), ROW_ID, train_pct, seed)
    ranked, best, summary, seconds = models.grid_search(spark, train, test, ROW_ID, grid=grid, seed=seed)
    base = out_dir.rstrip("/")
    write_report(ranked, f"{base}/ranked")
    write_report(summary.withColumn("seconds", F.lit(seconds)), f"{base}/best")
    save_model(best, f"{base}/model")
    return spark.read.json(f"{base}/best")


def _model(model_dir: str, kind: str):
    return load_model(f"{model_dir.rstrip('/')}/{kind}", kind)


def predict_job(spark: SparkSession, model_dir: str, test_path: str, out_path: str, kind: str = "logreg") -> DataFrame:
    """Score the saved test rows; write predictions (R5: label, prediction,
    probability and the vector); return accuracy (one row)."""
    test = models.as_vector(spark.read.parquet(test_path), "embedding")
    scored = _model(model_dir, kind).transform(test).withColumn("probability", vector_to_array("probability"))
    write_parquet(scored.select(ROW_ID, "processed_comment", "label", "prediction", "probability", "embedding"), out_path)
    return evaluate.accuracy(spark.read.parquet(out_path))


def score_job(
    spark: SparkSession,
    model_dir: str,
    texts_path: str,
    out_path: str,
    kind: str = "logreg",
    text_col: str = "text",
    encoder: Encoder | None = None,
) -> DataFrame:
    """Score new texts (parquet) with a saved model; blank texts are skipped."""
    rows = drop_blank(spark.read.parquet(texts_path), text_col)
    scored = score_texts(_model(model_dir, kind), rows, text_col, encoder)
    write_parquet(scored.drop("cleaned_comment", "features", "rawPrediction"), out_path)
    return spark.read.parquet(out_path)


def stream_job(
    spark: SparkSession,
    model_dir: str,
    directory: str,
    out_path: str,
    checkpoint: str,
    kind: str = "logreg",
    encoder: Encoder | None = None,
) -> DataFrame:
    """Score the files that arrived since the last run with a saved model."""
    run_available(_model(model_dir, kind), spark, directory, out_path, checkpoint, encoder=encoder)
    return spark.read.parquet(out_path)


def report_job(spark: SparkSession, predictions_path: str, out_dir: str) -> list[str]:
    """Project the embeddings to 3-D (PCA) and write the report tables."""
    scored = models.as_vector(spark.read.parquet(predictions_path), "embedding")
    projected = projection.pca_3d(scored).drop("features", "embedding")
    return write_reports(build_reports(projected, ROW_ID), out_dir)


def run_all(spark: SparkSession, csv_path: str, work_dir: str, mode: str = "compat") -> list[str]:
    base = work_dir.rstrip("/")
    preprocess_job(spark, csv_path, f"{base}/processed", mode)
    train_job(spark, f"{base}/processed", f"{base}/models", f"{base}/test")
    predict_job(spark, f"{base}/models", f"{base}/test", f"{base}/predictions")
    return report_job(spark, f"{base}/predictions", f"{base}/reports")
