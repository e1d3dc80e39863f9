"""TF-IDF parity with Spark ML, encoders, schema preview."""

import numpy as np
import pytest
from pyspark.ml.feature import IDF, CountVectorizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tonality.operators import features
from tonality.plans.catalog import all_documents
from tonality.sources.comments import schema_preview

from conftest import SF001


def test_relational_tfidf_equals_spark_ml(spark):
    docs = all_documents(spark, SF001).select("doc_id", "processed_comment")
    vocab_size = 1 << 20  # untruncated: no ties at the cut-off
    tf = features.term_frequency(docs, "doc_id", "processed_comment")
    vocab = features.vocabulary(tf, vocab_size)
    idf = features.idf(vocab, docs.count())
    rel = {(r["doc_id"], r["term"]): r["tfidf"] for r in features.tfidf(tf, idf).collect()}

    words = Tokenizer(inputCol="processed_comment", outputCol="w").transform(docs)
    cv = CountVectorizer(inputCol="w", outputCol="tf", vocabSize=vocab_size).fit(words)
    out = IDF(inputCol="tf", outputCol="v", minDocFreq=0).fit(cv.transform(words)).transform(cv.transform(words))
    terms = cv.vocabulary  # one JVM round trip, not one per entry
    ml = {}
    for r in out.select("doc_id", "v").collect():
        for i, val in zip(r["v"].indices, r["v"].values):
            ml[(r["doc_id"], terms[i])] = val
    # ML drops zero weights (terms in every document); compare the rest
    rel_nz = {k: v for k, v in rel.items() if v != 0.0}
    assert set(rel_nz) == set(ml)
    assert max(abs(rel_nz[k] - ml[k]) for k in ml) < 1e-9


def test_word2vec_encoder(spark):
    df = spark.createDataFrame([(["good", "video"],), (["bad", "video"],), ([],)], "toks array<string>")
    out = features.word2vec_vectors(df, "toks", dim=8, min_count=1)
    rows = out.select(vector_to_array("features").alias("v")).collect()
    assert all(len(r["v"]) == 8 for r in rows)


def test_batch_encoder_hook(spark):
    def make_predict_fn():
        def predict(texts):
            return np.stack([np.full(4, len(t), dtype=np.float32) for t in texts])

        return predict

    enc = features.batch_encoder(make_predict_fn, dim=4, batch_size=2)
    df = spark.createDataFrame([("ab",), ("abcd",), ("",)], "t string")
    got = [r[0] for r in df.select(enc(F.col("t"))).collect()]
    assert got == [[2.0] * 4, [4.0] * 4, [0.0] * 4]
    with pytest.raises(Exception, match="must have 5 components"):
        df.select(features.batch_encoder(make_predict_fn, dim=5)(F.col("t"))).collect()


def test_schema_preview(spark):
    df = spark.read.parquet(f"{SF001}/labels.parquet")
    tree, head = schema_preview(df, 5, order_by="doc_id")
    assert "doc_id" in tree and "quality" in tree
    ids = [r["doc_id"] for r in head.collect()]
    assert len(ids) == 5 and ids == sorted(ids)


def test_arrow_batches_are_bounded_in_bytes(spark):
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("int")
    def rows_in_batch(x: pa.Array) -> pa.Array:
        return pa.array([len(x)] * len(x), pa.int32())

    df = spark.range(0, 40, numPartitions=1).select(F.sequence(F.lit(1), F.lit(250_000)).alias("a"))  # 1 MB a row
    old = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")
    try:
        most = df.select(rows_in_batch("a").alias("n")).agg(F.max("n")).first()[0]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", old)
    assert most <= 6
