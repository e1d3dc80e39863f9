"""The four batch stages end to end on a CSV made from the test tables."""

import os

from pyspark.sql import functions as F

from tonality import jobs
from tonality.sources.comments import labelled_comments
from tonality.sources.sinks import write_comments_csv

from conftest import SF01


def test_run_all_strict(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "comments_csv")
    src = labelled_comments(spark, SF01).select("Comment", "Sentiment")
    write_comments_csv(src, csv)
    paths = jobs.run_all(spark, csv, os.path.join(tmp_dir, "work"), mode="strict")
    processed = spark.read.parquet(os.path.join(tmp_dir, "work", "processed"))
    assert processed.count() == src.count()
    assert jobs.read_rejected(spark, os.path.join(tmp_dir, "work", "processed")).count() == 0
    assert processed.select("row_id").distinct().count() == processed.count()
    preds = spark.read.parquet(os.path.join(tmp_dir, "work", "predictions"))
    test = spark.read.parquet(os.path.join(tmp_dir, "work", "test"))
    assert preds.count() == test.count() > 0
    names = {os.path.basename(p) for p in paths}
    assert {"sentiment_distribution", "confusion_matrix", "accuracy", "embedding_report", "hover_2d", "hover_3d", "points_3d"} <= names
    assert "probability" in preds.columns
    hover = spark.read.json(os.path.join(tmp_dir, "work", "reports", "hover_3d"))
    assert hover.count() == preds.count()
    dist = spark.read.json(os.path.join(tmp_dir, "work", "reports", "sentiment_distribution"))
    assert dist.agg(F.sum("n")).first()[0] == preds.count()


def test_strict_mode_keeps_bad_records_aside(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad.csv")
    with open(path, "w") as f:
        f.write('Comment,Sentiment\n"a, ""b""\nc",positive\nplain,neutral,extra\nfine,negative\n')
    out = os.path.join(tmp_dir, "processed")
    rows = jobs.preprocess_job(spark, path, out, "strict")
    assert sorted(r["label"] for r in rows.collect()) == [0, 2]
    assert [r[0] for r in jobs.read_rejected(spark, out).collect()] == ["plain,neutral,extra"]
    assert "rejected" not in rows.columns


def test_saved_model_scores_in_a_new_session(spark, tmp_dir):
    """Train, save, load in another session, score new texts, batch and stream,
    with another encoder than the default."""
    from tonality.__main__ import encoder_of

    csv = os.path.join(tmp_dir, "comments_csv")
    write_comments_csv(labelled_comments(spark, SF01).select("Comment", "Sentiment"), csv)
    at = lambda name: os.path.join(tmp_dir, name)
    encoder = encoder_of("hashed:32")
    jobs.preprocess_job(spark, csv, at("processed"), "strict")
    jobs.train_job(spark, at("processed"), at("models"), at("test"), encoder=encoder)
    other = spark.newSession()
    rows = [(1, 0, "user", "good great text"), (1, 1, "user", "   "), (2, 0, "bot", None), (2, 1, "bot", "12 ! 3")]
    schema = "conv_id long, turn long, role string, text string"
    other.createDataFrame(rows, schema).coalesce(1).write.parquet(at("texts"))
    for kind in ("logreg", "forest"):
        scored = jobs.score_job(other, at("models"), at("texts"), at(f"scored-{kind}"), kind, encoder=encoder)
        assert sorted((r["conv_id"], r["turn"]) for r in scored.collect()) == [(1, 0), (2, 1)]
        for r in scored.collect():
            assert abs(sum(r["probability"]) - 1) < 1e-9 and r["probability"][int(r["prediction"])] == max(r["probability"])
    columns = ["conv_id", "turn", "probability", "prediction", "sentiment"]
    stream = jobs.stream_job(other, at("models"), at("texts"), at("streamed"), at("ckpt"), encoder=encoder)
    batch = other.read.parquet(at("scored-logreg"))
    assert sorted(stream.select(columns).collect()) == sorted(batch.select(columns).collect())


def test_grid_job_writes_the_best_set(spark, tmp_dir):
    csv = os.path.join(tmp_dir, "comments_csv")
    write_comments_csv(labelled_comments(spark, SF01).select("Comment", "Sentiment"), csv)
    jobs.preprocess_job(spark, csv, os.path.join(tmp_dir, "processed"), "strict")
    grid = {"regParam": [0.01, 1.0], "elasticNetParam": [0.0], "maxIter": [5]}
    best = jobs.grid_job(spark, os.path.join(tmp_dir, "processed"), os.path.join(tmp_dir, "grid"), grid=grid).first()
    ranked = spark.read.json(os.path.join(tmp_dir, "grid", "ranked"))
    assert ranked.count() == 2 and best["test_n"] > 0
    assert ranked.where("rank = 1").first()["regParam"] == best["regParam"]
