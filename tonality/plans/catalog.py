"""The query catalogue: one callable (spark, sf_dir) -> DataFrame per operator.

Each query reads the stand-in tables whole. Doubles that are compared with
the SQL oracle are rounded to 6 places; vectors are not returned (sparse
rows instead).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import (
    decode_color,
    decode_emoji,
    decode_label,
    decode_style,
    encode_label,
    sentiment_from_flags,
)
from ..functions.preview import hover_3d, preview_2d, preview_3d
from ..functions.text import content_tokens, is_empty, ml_tokens, preview_source
from ..operators import evaluate, features, landmarks, models, naive_bayes, nb_store, projection, uncertainty
from ..operators.batched_grid import grid_search_batched
from ..operators.preprocess import preprocess
from ..operators.scoring import drop_blank, embed_texts, score_texts
from ..operators.split import bucket, exact_sample, train_test_split, with_split
from ..session import scratch_path
from ..sources.comments import conversation_texts, labelled_comments, table
from ..sources.sinks import cut_lineage
from ..streaming.score_stream import OUTPUT_COLUMNS, run_available

SEED = 42
TRAIN_PCT = 80
SAMPLE_N = 3000
BOOTSTRAP_LEVEL, BOOTSTRAP_REPLICATES = 0.9, 64
DIGITS = 6


def r6(c):
    return F.round(c, DIGITS)


# ---- shared inputs ------------------------------------------------------------


def all_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every document, preprocessed (no label)."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("Comment"))
    return preprocess(docs, sentiment_col=None)


def labelled_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with labels, preprocessed: doc_id, Comment, Sentiment, cleaned, processed, label."""
    return preprocess(labelled_comments(spark, sf))


def labelled_split(spark: SparkSession, sf: str):
    return train_test_split(labelled_documents(spark, sf), "doc_id", TRAIN_PCT, SEED)


def embedding_rows(spark: SparkSession, sf: str) -> DataFrame:
    """vec_id, embedding, label (three classes: label % 3), features (vector)."""
    e = table(spark, sf, "embeddings").select(
        "vec_id", "embedding", (F.col("label") % 3).cast("int").alias("label")
    )
    return models.as_vector(e, "embedding")


def embedding_split(spark: SparkSession, sf: str):
    return train_test_split(embedding_rows(spark, sf), "vec_id", TRAIN_PCT, SEED)


def label_and_vector(train: DataFrame) -> DataFrame:
    """What a fit reads, and all that is persisted for it: no array beside the vector."""
    return train.select("label", "features")


def embedding_sample(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select(
        "vec_id", "embedding", (F.col("label") % 3).cast("int").alias("label")
    )
    return projection.first_three(exact_sample(e, "vec_id", SAMPLE_N, SEED), "embedding")


# ---- text ------------------------------------------------------------------------


def q_clean_text(spark, sf):
    return all_documents(spark, sf).select("doc_id", "cleaned_comment")


def q_tokenize_stop(spark, sf):
    d = all_documents(spark, sf)
    return d.select(
        "doc_id",
        "processed_comment",
        F.when(F.col("processed_comment") == "", F.lit(0))
        .otherwise(F.size(F.split("processed_comment", " ")))
        .alias("n_tokens"),
        is_empty(F.col("processed_comment")).alias("is_empty"),
    )


def q_preview_text(spark, sf):
    # the source text is a column of its own, so both previews share it
    d = all_documents(spark, sf).withColumn("_src", preview_source(F.col("processed_comment")))
    src = F.col("_src")
    return d.select("doc_id", preview_3d(src).alias("preview_3d"), preview_2d(src).alias("preview_2d"))


# ---- labels ----------------------------------------------------------------------


def _label_rows(spark, sf):
    return table(spark, sf, "labels").select(
        "doc_id", sentiment_from_flags(F.col("toxic"), F.col("quality")).alias("Sentiment")
    )


def q_label_encode(spark, sf):
    return _label_rows(spark, sf).withColumn("label", encode_label(F.col("Sentiment")))


def q_label_audit(spark, sf):
    return evaluate.label_audit(q_label_encode(spark, sf))


def q_label_decode(spark, sf):
    lab = F.col("label")
    return q_label_encode(spark, sf).select(
        "doc_id",
        "label",
        decode_label(lab).alias("sentiment"),
        decode_emoji(lab).alias("emoji"),
        decode_style(lab).alias("style"),
        decode_color(lab).alias("color"),
    )


def q_sentiment_distribution(spark, sf):
    return evaluate.class_counts(labelled_documents(spark, sf), "label")


def _labels_of_documents(spark, sf) -> DataFrame:
    """doc_id and label of the labelled documents, once in the shared folder:
    class sizes and rows both come from it, so each table is scanned once."""
    return cut_lineage(spark, labelled_documents(spark, sf).select("doc_id", "label"), "labels-of-documents")


def q_class_slice(spark, sf):
    return evaluate.class_slice(_labels_of_documents(spark, sf), "label").select("doc_id", "sentiment", "class_size")


def q_class_slice_positive(spark, sf):
    """The rows of one class."""
    rows = evaluate.class_slice(_labels_of_documents(spark, sf), "label", name="Positive")
    return rows.select("doc_id", "sentiment", "class_size")


def q_value_counts(spark, sf):
    """Documents per class name among the sampled points, most frequent first."""
    named = embedding_sample(spark, sf).select(decode_label(F.col("label")).alias("sentiment"))
    return evaluate.value_counts(named, "sentiment")


def q_csv_ingest(spark, sf):
    """Labelled comments written as CSV to the shared folder, read back in
    strict mode, and audited: rows and characters per sentiment and label."""
    return _csv_audit(spark, sf, "strict")


def q_csv_splits(spark, sf):
    """The same, with the files read in splits."""
    return _csv_audit(spark, sf, "splits")


def _csv_audit(spark, sf, mode):
    from ..sources.comments import read_comments_csv
    from ..sources.sinks import write_comments_csv

    path = scratch_path(spark, "csv-ingest")
    write_comments_csv(labelled_comments(spark, sf).select("Comment", "Sentiment"), path)
    back = read_comments_csv(spark, path, mode).drop("_corrupt_record")
    return (
        back.withColumn("label", encode_label(F.col("Sentiment")))
        .groupBy("Sentiment", "label")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.coalesce(F.col("Comment"), F.lit("")))).alias("chars"))
    )


# ---- split and sample --------------------------------------------------------------


def q_train_test_split(spark, sf):
    return with_split(table(spark, sf, "documents").select("doc_id"), "doc_id", TRAIN_PCT, SEED)


def q_embedding_sample(spark, sf):
    return embedding_sample(spark, sf).select("vec_id", "label")


# ---- term statistics ----------------------------------------------------------------


def _tf(spark, sf):
    return features.term_frequency(all_documents(spark, sf), "doc_id", "processed_comment")


def q_term_frequency(spark, sf):
    return _tf(spark, sf).select("doc_id", "term", F.col("tf").cast("long").alias("tf"))


def q_vocabulary(spark, sf):
    return features.vocabulary(_tf(spark, sf), features.DEFAULT_VOCAB_SIZE)


def _tf_once(spark, sf):
    """Term rows from term counts written once per document: the text chain
    runs once, however often the rows are read."""
    counted = all_documents(spark, sf).select("doc_id", features.term_counts(ml_tokens(F.col("processed_comment"))).alias("terms"))
    return cut_lineage(spark, counted, "term-counts").select("doc_id", F.inline("terms"))


def _idf(spark, sf, tf):
    """The idf table of term rows, in the shared folder."""
    n_docs = table(spark, sf, "documents").agg(F.count(F.lit(1))).scalar()
    vocab = features.vocabulary(tf, features.DEFAULT_VOCAB_SIZE)
    return cut_lineage(spark, features.idf(vocab, n_docs), "idf")


def q_idf(spark, sf):
    idf = _idf(spark, sf, _tf(spark, sf))
    return idf.select("term", "df", r6(F.col("idf")).alias("idf"))


def q_tfidf(spark, sf):
    tf = _tf_once(spark, sf)
    idf = _idf(spark, sf, tf)
    return features.tfidf(tf, idf).select(
        "doc_id", "term", F.col("tf").cast("long").alias("tf"), r6(F.col("tfidf")).alias("tfidf")
    )


def q_hash_embedding(spark, sf):
    d = all_documents(spark, sf).select(
        "doc_id", features.hashed_vector(content_tokens(F.col("cleaned_comment"))).alias("v")
    )
    return d.select("doc_id", F.inline(features.sparse_entries(F.col("v")))).select(
        "doc_id", "dim", r6(F.col("value")).alias("value")
    )


# ---- Naive Bayes ----------------------------------------------------------------------


def _nb_fit_score(spark, sf):
    train, test = labelled_split(spark, sf)
    model = naive_bayes.fit(train, "doc_id")
    return model, naive_bayes.score(model, test, "doc_id", keep=["label"])


def q_nb_model(spark, sf):
    train, _ = labelled_split(spark, sf)
    model = naive_bayes.fit(train, "doc_id")
    return naive_bayes.model_table(model).select(
        "label", "term", r6(F.col("prior")).alias("prior"), r6(F.col("theta")).alias("theta")
    )


def q_nb_incremental(spark, sf):
    """The model of two batches, counted one after the other into the versioned
    statistics (the first is sent again, which adds nothing)."""
    train, _ = labelled_split(spark, sf)
    train = cut_lineage(spark, train.select("doc_id", "processed_comment", "label"), "nb-batches")
    path = scratch_path(spark, "nb-statistics")
    even = bucket(F.col("doc_id"), SEED + 2, 2) == 0
    for name, batch in (("even", train.where(even)), ("odd", train.where(~even)), ("even", train.where(even))):
        nb_store.update(spark, path, batch, name)
    return naive_bayes.model_table(nb_store.fit_stored(spark, path)).select(
        "label", "term", r6(F.col("prior")).alias("prior"), r6(F.col("theta")).alias("theta")
    )


def q_nb_score(spark, sf):
    _, scored = _nb_fit_score(spark, sf)
    return scored.select("doc_id", "label", "prediction")


def q_accuracy(spark, sf):
    _, scored = _nb_fit_score(spark, sf)
    return evaluate.accuracy(scored).select("n", r6(F.col("accuracy")).alias("accuracy"))


def _nb_hits(spark, sf):
    """Held-out rows with the hits of Naive Bayes and of the most frequent class."""
    model, scored = _nb_fit_score(spark, sf)
    most = model.classes[int(np.argmax(model.priors))]  # ties: the lower class
    label = F.col("label")
    return scored, {"naive_bayes": uncertainty.hit(label, F.col("prediction")), "majority": uncertainty.hit(label, F.lit(most))}


def q_accuracy_interval(spark, sf):
    scored, hits = _nb_hits(spark, sf)
    found = uncertainty.accuracy_interval(scored, "doc_id", hits, BOOTSTRAP_LEVEL, BOOTSTRAP_REPLICATES, SEED)
    return found.select("model", "n", *[r6(F.col(c)).alias(c) for c in ("accuracy", "low", "high")])


def q_accuracy_bootstrap(spark, sf):
    scored, hits = _nb_hits(spark, sf)
    return uncertainty.bootstrap(scored, "doc_id", hits, BOOTSTRAP_REPLICATES, SEED)


def q_paired_test(spark, sf):
    scored, hits = _nb_hits(spark, sf)
    found = uncertainty.paired_test(scored, hits["naive_bayes"], hits["majority"])
    return found.select("n", "only_first", "only_second", *[r6(F.col(c)).alias(c) for c in ("statistic", "p_value")])


def q_confusion_matrix(spark, sf):
    _, scored = _nb_fit_score(spark, sf)
    return evaluate.confusion_matrix(scored)


def q_nb_pipeline(spark, sf):
    """The Spark ML pipeline on the relational vocabulary (top 5000 terms, ties
    by term), so that SQL can state its predictions."""
    train, test = labelled_split(spark, sf)
    rows = cut_lineage(spark, train.select("doc_id", "processed_comment", "label"), "nb-train")
    tf = features.term_frequency(rows, "doc_id", "processed_comment")
    top = features.vocabulary(tf, features.DEFAULT_VOCAB_SIZE).orderBy("rank").select("term")
    terms = [r["term"] for r in top.collect()]  # at most 5000 strings
    fitted = models.nb_pipeline(vocabulary=terms).fit(rows)
    return fitted.transform(test).select("doc_id", "label", "prediction")


# ---- models on embeddings ----------------------------------------------------------------


def q_lr_train_score(spark, sf):
    train, test = embedding_split(spark, sf)
    with models.persisted(label_and_vector(train)) as rows:
        lr = models.train_logreg(rows)
    return lr.transform(test).select("vec_id", "label", "prediction")


def q_rf_train_score(spark, sf):
    train, test = embedding_split(spark, sf)
    with models.persisted(label_and_vector(train)) as rows:
        rf = models.train_forest(rows)
    return rf.transform(test).select("vec_id", "label", "prediction")


def q_model_compare(spark, sf):
    train, test = embedding_split(spark, sf)
    with models.persisted(label_and_vector(train)) as rows:
        lr, rf = models.train_logreg(rows), models.train_forest(rows)
    return models.compare_models({"logistic_regression": lr, "random_forest": rf}, test)


def q_grid_search(spark, sf):
    train, test = embedding_split(spark, sf)
    ranked, _, _, _ = models.grid_search(spark, train, test, "vec_id")
    return ranked


def _batched(spark, sf):
    train, _ = embedding_split(spark, sf)
    return grid_search_batched(spark, train, "vec_id")[0]


def q_grid_batched(spark, sf):
    """The grid search with the gradients of all models in one scan."""
    return _batched(spark, sf).select("rank", "accuracy", "regParam", "elasticNet", "maxIter")


def q_grid_batched_check(spark, sf):
    """The parameter sets with whether all their models meet the conditions of
    an optimum, and whether the accuracy is that of a fold mean."""
    ranked = _batched(spark, sf)
    fine = (F.col("residual") < 1e-5) & F.col("accuracy").between(0, 1)
    return ranked.select("regParam", "elasticNet", "maxIter", fine.alias("optimal"))


def q_landmark_projection(spark, sf):
    e = embedding_rows(spark, sf).select("vec_id", "label", "embedding")
    placed = landmarks.landmark_3d(e, "vec_id")
    return placed.select("vec_id", "label", *[r6(F.col(a)).alias(a) for a in "xyz"])


def q_landmark_check(spark, sf):
    """Points, whether all have coordinates, and whether distances of a sample
    are kept better than by principal components."""
    e = embedding_rows(spark, sf)
    placed = cut_lineage(spark, landmarks.landmark_3d(e.drop("features"), "vec_id"), "landmarks")
    ours, pca = landmarks.stress(placed, "vec_id", "embedding"), landmarks.stress(projection.pca_3d(e), "vec_id", "embedding")
    placed_all = F.count_if(F.col("x").isNull() | F.isnan("x")) == 0
    return placed.agg(F.count(F.lit(1)).alias("n"), placed_all.alias("placed"), F.lit(ours < pca).alias("better"))


def q_embedding_projection(spark, sf):
    e = embedding_rows(spark, sf)
    return projection.pca_3d(e).select(
        "vec_id", "label", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"), r6(F.col("z")).alias("z")
    )


# ---- checks of fitted models: results that SQL can state -------------------------------


def q_lr_check(spark, sf):
    """Test rows, rows whose prediction isn't arg max(Wx + b), and whether the
    gradient of the fitted loss is near zero (largest entry below 0.01, in the
    space of scaled features where Spark applies the penalty)."""
    train, test = embedding_split(spark, sf)
    with models.persisted(label_and_vector(train)) as rows:
        lr = models.train_logreg(rows)
    w, b = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()  # classes x 64
    rows = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in w])
    x = F.col("embedding").cast("array<double>")
    margin = [
        F.aggregate(F.zip_with(x, rows[c], lambda p, q: p * q), F.lit(float(b[c])), lambda s, v: s + v) for c in range(len(b))
    ]
    best = F.greatest(*margin)
    own = F.element_at(F.array(*margin), F.col("prediction").cast("int") + 1)
    wrong = lr.transform(test).agg(F.count(F.lit(1)).alias("n"), F.count_if(own < best - 1e-9).alias("mismatches"))

    scored = lr.transform(train).select("label", vector_to_array("probability").alias("p"), F.posexplode(x).alias("j", "x"))
    slope = [F.avg((F.col("p")[c] - (F.col("label") == c).cast("double")) * F.col("x")).alias(f"g_{c}") for c in range(len(b))]
    per_dim = scored.groupBy("j").agg(F.stddev_samp("x").alias("sd"), *slope)
    penalty = models.LR_PARAMS["regParam"]
    entry = [F.abs(F.col(f"g_{c}") / F.col("sd") + penalty * F.get(rows[c], F.col("j")) * F.col("sd")) for c in range(len(b))]
    largest = per_dim.agg(F.max(F.greatest(*entry)).alias("g"))
    return wrong.crossJoin(largest).select("n", "mismatches", (F.col("g") < 0.01).alias("converged"))  # one row each


def q_rf_check(spark, sf):
    """Test rows, rows whose prediction isn't the most probable class, and rows
    whose probabilities don't sum to 1."""
    train, test = embedding_split(spark, sf)
    with models.persisted(label_and_vector(train)) as rows:
        rf = models.train_forest(rows)
    p = vector_to_array("probability")
    scored = rf.transform(test).select("prediction", p.alias("p"))
    total = F.aggregate("p", F.lit(0.0), lambda a, v: a + v)
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.element_at("p", F.col("prediction").cast("int") + 1) < F.array_max("p")).alias("mismatches"),
        F.count_if(F.abs(total - 1) > 1e-9).alias("bad_sums"),
    )


def q_model_compare_check(spark, sf):
    """Per model: test rows, and whether the reported accuracy is the share on
    the diagonal of the confusion matrix."""
    train, test = embedding_split(spark, sf)
    with models.persisted(label_and_vector(train)) as rows:
        fitted = {"logistic_regression": models.train_logreg(rows), "random_forest": models.train_forest(rows)}
    table_ = models.compare_models(fitted, test)
    parts = []
    for name, model in fitted.items():
        cm = evaluate.confusion_matrix(model.transform(test))
        columns = [F.col(f"pred_{n}") for n in ("negative", "neutral", "positive")]
        own = F.element_at(F.array(*columns), F.col("true_label") + 1)
        parts.append(cm.agg((F.sum(own) / F.sum(sum(columns, F.lit(0)))).alias("share")).select(F.lit(name).alias("model"), "share"))
    both = table_.join(parts[0].unionByName(parts[1]), "model")
    return both.select("model", "n", (F.abs(F.col("accuracy") - F.col("share")) < 1e-12).alias("consistent"))


def q_grid_check(spark, sf):
    """The parameter sets with whether each stands in its place: accuracies
    fall with the rank, ties in parameter order, and the best set is the one
    that was refitted and has a test accuracy."""
    train, test = embedding_split(spark, sf)
    ranked, _, summary, _ = models.grid_search(spark, train, test, "vec_id")
    before = Window.orderBy("rank")
    key = F.struct(-F.col("accuracy"), "regParam", "elasticNet", "maxIter")
    ordered = ranked.withColumn("in_order", F.coalesce(F.lag(key).over(before) < key, F.lit(True)))
    best = summary.select(
        F.col("regParam").alias("b_reg"), F.col("elasticNet").alias("b_net"), F.col("maxIter").alias("b_iter"),
        F.col("cv_accuracy").alias("b_acc"), F.col("test_accuracy").between(0, 1).alias("b_ok"),
    )
    # one row of a summary beside at most 18 sets
    top = ordered.crossJoin(best).withColumn(
        "best_set",
        (F.col("regParam") == F.col("b_reg")) & (F.col("elasticNet") == F.col("b_net")) & (F.col("maxIter") == F.col("b_iter")),
    )
    first_ok = F.col("best_set") & F.col("b_ok") & (F.abs(F.col("accuracy") - F.col("b_acc")) < 1e-12)
    return top.select("regParam", "elasticNet", "maxIter", (F.col("in_order") & F.when(F.col("rank") == 1, first_ok).otherwise(True)).alias("in_place"))


def q_embedding_covariance(spark, sf):
    e = table(spark, sf, "embeddings").select("embedding")
    cov = r6(F.col("cov"))
    return projection.covariance(e, "embedding").select("i", "j", F.when(cov == 0, F.lit(0.0)).otherwise(cov).alias("cov"))


def q_pca_check(spark, sf):
    """Points, whether the loadings are orthonormal, and whether they are the
    leading eigenvectors of the covariance (residual, and order of size)."""
    e = embedding_rows(spark, sf)
    loadings = projection.fit_pca(e).pc.toArray()
    d = len(loadings)
    cov = np.zeros((d, d))
    for r in projection.covariance(e, "embedding").collect():  # d (d + 1) / 2 numbers
        cov[r["i"], r["j"]] = cov[r["j"], r["i"]] = r["cov"]
    size = np.einsum("ik,ij,jk->k", loadings, cov, loadings)
    orthonormal = bool(np.abs(loadings.T @ loadings - np.eye(3)).max() < 1e-9)
    residual = np.abs(cov @ loadings - loadings * size).max() < 1e-6
    leading = bool(residual and np.allclose(size, np.sort(np.linalg.eigvalsh(cov))[::-1][:3], atol=1e-6))
    return e.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(orthonormal).alias("orthonormal"), F.lit(leading).alias("leading"))


def q_stream_check(spark, sf):
    """Scored texts, and rows that only the stream or only the batch has."""
    model = sentiment_model(spark, sf)
    batch = cut_lineage(spark, _scored_batch(model, spark, sf), "batch")
    stream = _scored_stream(model, spark, sf)
    counted = [df.agg(F.count(F.lit(1)).alias(n)) for n, df in (
        ("n", batch), ("only_stream", stream.exceptAll(batch)), ("only_batch", batch.exceptAll(stream)))]
    return counted[0].crossJoin(counted[1]).crossJoin(counted[2])  # one row each


def q_planar_projection(spark, sf):
    p = projection.planar(embedding_sample(spark, sf), "vec_id", "label")
    return p.select("vec_id", "sentiment", "plane", r6(F.col("a")).alias("a"), r6(F.col("b")).alias("b"))


def q_embedding_report(spark, sf):
    rep = projection.embedding_report(embedding_sample(spark, sf), "label")
    return rep.select(*[r6(F.col(c)).alias(c) if c.startswith(("var_", "range_")) else F.col(c) for c in rep.columns])


def q_hover_text(spark, sf):
    """Hover labels of the 3-D chart, one per sampled point: its first three
    components as coordinates, its class as prediction, the document's label
    (if it has one) as truth, and the size of its class in the sample.

    The sample is bounded (``SAMPLE_N`` rows) and materialised, so it is
    broadcast to the documents and to the labels; only its own documents are
    cleaned and tokenized.
    """
    points = embedding_sample(spark, sf).select(
        F.col("vec_id").alias("doc_id"), decode_label(F.col("label")).alias("pred_name"), "x", "y", "z"
    )
    points = cut_lineage(spark, points, "hover-sample")
    ids = F.broadcast(points.select("doc_id"))
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("Comment")).join(ids, "doc_id")
    docs = preprocess(docs, sentiment_col=None).select("doc_id", "processed_comment")
    truth = _label_rows(spark, sf).join(ids, "doc_id").select("doc_id", encode_label(F.col("Sentiment")).alias("true_label"))
    joined = evaluate.with_class_size(points, "pred_name").join(docs, "doc_id", "left").join(truth, "doc_id", "left")
    return joined.select(
        "doc_id",
        hover_3d(
            F.col("pred_name"),
            F.col("class_size"),
            preview_3d(preview_source(F.col("processed_comment"))),
            decode_label(F.col("true_label")),
            F.col("x"),
            F.col("y"),
            F.col("z"),
        ).alias("hover"),
    )


# ---- scoring free text --------------------------------------------------------------------


def sentiment_model(spark, sf):
    """LR on hashed embeddings of the labelled documents (train split). Only
    label and vector are kept for the fit."""
    train, _ = labelled_split(spark, sf)
    featured = embed_texts(train.select("doc_id", "Comment", "label"), "Comment", keep_text=False).select("label", "features")
    with models.persisted(featured):
        return models.train_logreg(featured)


def _scored_batch(model, spark, sf) -> DataFrame:
    return score_texts(model, drop_blank(conversation_texts(spark, sf))).select(*OUTPUT_COLUMNS)


def _scored_stream(model, spark, sf) -> DataFrame:
    """The table may be one file or a folder of files; a stream takes either
    only by a glob, which here matches nothing but the table."""
    sink = scratch_path(spark, "score-stream-out")
    run_available(model, spark, f"{sf.rstrip('/')}/conversations.parque[t]", sink, scratch_path(spark, "score-stream-ckpt"))
    return spark.read.parquet(sink).select(*OUTPUT_COLUMNS)


def q_score_batch(spark, sf):
    return _scored_batch(sentiment_model(spark, sf), spark, sf)


def q_score_stream(spark, sf):
    return _scored_stream(sentiment_model(spark, sf), spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_text": q_clean_text,
    "tokenize_stop": q_tokenize_stop,
    "label_encode": q_label_encode,
    "label_audit": q_label_audit,
    "label_decode": q_label_decode,
    "csv_ingest": q_csv_ingest,
    "csv_splits": q_csv_splits,
    "sentiment_distribution": q_sentiment_distribution,
    "class_slice": q_class_slice,
    "class_slice_positive": q_class_slice_positive,
    "value_counts": q_value_counts,
    "train_test_split": q_train_test_split,
    "embedding_sample": q_embedding_sample,
    "term_frequency": q_term_frequency,
    "vocabulary": q_vocabulary,
    "idf": q_idf,
    "tfidf": q_tfidf,
    "hash_embedding": q_hash_embedding,
    "nb_model": q_nb_model,
    "nb_incremental": q_nb_incremental,
    "nb_score": q_nb_score,
    "accuracy": q_accuracy,
    "confusion_matrix": q_confusion_matrix,
    "accuracy_interval": q_accuracy_interval,
    "accuracy_bootstrap": q_accuracy_bootstrap,
    "paired_test": q_paired_test,
    "nb_pipeline": q_nb_pipeline,
    "lr_train_score": q_lr_train_score,
    "rf_train_score": q_rf_train_score,
    "model_compare": q_model_compare,
    "grid_search": q_grid_search,
    "grid_batched": q_grid_batched,
    "grid_batched_check": q_grid_batched_check,
    "landmark_projection": q_landmark_projection,
    "landmark_check": q_landmark_check,
    "embedding_projection": q_embedding_projection,
    "planar_projection": q_planar_projection,
    "embedding_report": q_embedding_report,
    "preview_text": q_preview_text,
    "hover_text": q_hover_text,
    "score_batch": q_score_batch,
    "score_stream": q_score_stream,
    "lr_check": q_lr_check,
    "rf_check": q_rf_check,
    "model_compare_check": q_model_compare_check,
    "grid_check": q_grid_check,
    "embedding_covariance": q_embedding_covariance,
    "pca_check": q_pca_check,
    "stream_check": q_stream_check,
}
