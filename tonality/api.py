"""Public API: DataFrame -> DataFrame functions for each step of the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .operators.evaluate import accuracy as evaluate  # noqa: F401
from .operators.evaluate import class_counts, confusion_matrix  # noqa: F401
from .operators.features import hashed_vector as embed_tokens  # noqa: F401
from .operators.models import train_forest, train_logreg  # noqa: F401
from .operators.preprocess import preprocess  # noqa: F401
from .operators.report import build_reports, write_reports  # noqa: F401
from .operators.projection import embedding_report, pca_3d as project, planar  # noqa: F401
from .operators.scoring import embed_texts as embed, score_texts as score  # noqa: F401
from .operators.split import train_test_split as split  # noqa: F401
from .sources.comments import read_comments_csv as read_comments  # noqa: F401


def train(df: DataFrame, kind: str = "logreg", **params):
    """Fit a model on a DataFrame with ``features`` and ``label``."""
    from .operators import models

    fit = {"logreg": models.train_logreg, "forest": models.train_forest}[kind]
    with models.persisted(df):
        return fit(df, **params)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents -> preprocess -> hashed embedding -> key-hash split
    -> logistic regression -> 3 x 3 confusion matrix on the test rows."""
    from .operators.evaluate import confusion_matrix as cm
    from .plans.catalog import labelled_split, sentiment_model

    model = sentiment_model(spark, sf_dir)
    _, test = labelled_split(spark, sf_dir)
    scored = model.transform(embed(test.select("doc_id", "Comment", "label"), "Comment"))
    return cm(scored)


def report(scored: DataFrame, id_col: str, path: str, **kwargs) -> list[str]:
    """Build the report tables of ``scored`` and write them under ``path``."""
    return write_reports(build_reports(scored, id_col, **kwargs), path)
