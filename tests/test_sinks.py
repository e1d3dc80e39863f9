"""Sinks: model save/load round trip and written report tables."""

import json
import os

from tonality.api import report
from tonality.operators import models, projection
from tonality.plans.catalog import embedding_split
from tonality.sources.sinks import load_model, save_model

from conftest import SF01


def test_model_round_trip(spark, tmp_dir):
    train, test = embedding_split(spark, SF01)
    lr = models.train_logreg(train)
    path = os.path.join(tmp_dir, "lr")
    save_model(lr, path)
    again = load_model(path, "logreg")
    a = sorted(lr.transform(test).select("vec_id", "prediction").collect())
    b = sorted(again.transform(test).select("vec_id", "prediction").collect())
    assert a == b


def test_reports_written(spark, tmp_dir):
    train, test = embedding_split(spark, SF01)
    scored = models.train_logreg(train).transform(test)
    scored = projection.first_three(scored, "embedding")
    paths = report(scored, "vec_id", os.path.join(tmp_dir, "reports"), text_col=None)
    names = {os.path.basename(p) for p in paths}
    assert {"sentiment_distribution", "confusion_matrix", "accuracy", "planar_projection", "embedding_report"} <= names
    dist = spark.read.json(os.path.join(tmp_dir, "reports", "sentiment_distribution")).collect()
    assert sum(r["n"] for r in dist) == test.count()
