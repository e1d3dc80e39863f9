"""Term counts, hashed encoder and relational Naive Bayes vs Spark ML."""

import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from tonality.operators import features, naive_bayes
from tonality.operators.models import nb_pipeline
from tonality.plans.catalog import labelled_split

from conftest import SF01


def test_term_counts_match_counter(spark):
    rows = [(1, ["b", "a", "b", "c", "b"]), (2, []), (3, [""]), (4, ["z"])]
    df = spark.createDataFrame(rows, "id int, toks array<string>")
    got = {}
    for r in df.select("id", F.inline(features.term_counts(F.col("toks")))).collect():
        got.setdefault(r["id"], {})[r["term"]] = r["tf"]
    for i, toks in rows:
        assert got.get(i, {}) == dict(Counter(toks))


def py_hashed(tokens, dim=384):
    v = [0.0] * dim
    for t in tokens:
        h = hashlib.md5(t.encode()).hexdigest()
        v[int(h[:8], 16) % dim] += 1.0 if h[8] < "8" else -1.0
    n = math.sqrt(sum(x * x for x in v))
    return [x / n for x in v] if n else v


def test_hashed_vector_matches_python_and_norm(spark):
    rows = [(1, ["good", "bad", "good"]), (2, []), (3, ["x"] * 5 + ["y"])]
    df = spark.createDataFrame(rows, "id int, toks array<string>")
    got = {r[0]: r[1] for r in df.select("id", features.hashed_vector(F.col("toks"))).collect()}
    for i, toks in rows:
        exp = py_hashed(toks)
        assert max(abs(a - b) for a, b in zip(got[i], exp)) < 1e-12
        norm = math.sqrt(sum(x * x for x in got[i]))
        assert abs(norm - (1.0 if toks else 0.0)) < 1e-9


def test_relational_nb_equals_spark_ml(spark):
    """Same vocabulary (untruncated), same IDF, same NB -> same predictions."""
    train, test = labelled_split(spark, SF01)
    vocab = 1 << 20  # larger than the corpus, so no tie at the cut-off
    model = naive_bayes.fit(train, "doc_id", vocab_size=vocab)
    rel = {r["doc_id"]: r["prediction"] for r in naive_bayes.score(model, test, "doc_id").collect()}
    ml = nb_pipeline(vocab_size=vocab).fit(train).transform(test)
    ml_pred = {r["doc_id"]: r["prediction"] for r in ml.select("doc_id", "prediction").collect()}
    assert rel == ml_pred
    assert len(rel) > 50


def test_relational_nb_parameters_equal_spark_ml(spark):
    train, _ = labelled_split(spark, SF01)
    vocab = 1 << 20
    model = naive_bayes.fit(train, "doc_id", vocab_size=vocab)
    fitted = nb_pipeline(vocab_size=vocab).fit(train)
    cv, nb = fitted.stages[1], fitted.stages[3]
    terms = cv.vocabulary
    pi = nb.pi.toArray()
    theta = nb.theta.toArray()
    assert model.classes == list(range(len(pi)))
    assert max(abs(p - q) for p, q in zip(model.priors, pi, strict=True)) < 1e-9
    rel = {r["term"]: r for r in model.terms.collect()}
    worst = 0.0
    for j, term in enumerate(terms):
        for c in range(theta.shape[0]):
            worst = max(worst, abs(rel[term]["theta"][c] - theta[c, j]))
    assert worst < 1e-9


def test_nb_takes_the_classes_of_the_data(spark):
    import numpy as np
    import pytest

    texts = [("a b", 0), ("b c", 1), ("c d", 2), ("d e e", 3), ("a a", 0), ("e", 3), ("", 1)] * 3
    df = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(texts)], "id int, processed_comment string, label int")
    for lam in (1.0, 0.5, 0.0):
        model = naive_bayes.fit(df, "id", smoothing=lam)
        assert model.classes == [0, 1, 2, 3] and model.smoothing == lam
        rows = naive_bayes.score(model, df, "id", keep=["label"]).collect()
        assert len(rows) == len(texts)
        if lam:
            fitted = nb_pipeline(smoothing=lam).fit(df)
            assert np.allclose(model.priors, fitted.stages[3].pi.toArray())
            ml = {r["id"]: r["prediction"] for r in fitted.transform(df).collect()}
            assert {r["id"]: r["prediction"] for r in rows} == ml
    with pytest.raises(ValueError):
        naive_bayes.fit(df.withColumn("label", F.lit(-1)), "id")
    with pytest.raises(ValueError):
        naive_bayes.fit(df.limit(0), "id")


def test_zero_is_a_smoothing_and_a_vocabulary_can_be_given(spark):
    assert nb_pipeline(smoothing=0.0).getStages()[3].getSmoothing() == 0.0
    stage = nb_pipeline(vocabulary=["b", "a", "c"], vocab_size=2).getStages()[1]
    assert stage.vocabulary == ["b", "a"]


def test_measured_broadcast_looks_at_the_size(spark):
    small = spark.createDataFrame([("a", 1.0)], "term string, idf double")
    plan = lambda df: features.measured_broadcast(df)._jdf.queryExecution().logical().toString()
    assert "broadcast" in plan(small)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "broadcast" not in plan(small)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
