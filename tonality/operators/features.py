"""Text features: term counts, vocabulary, IDF, TF-IDF and the hashed encoder.

Scale notes
-----------
* Term counts per document are computed *inside the row* (sort the token
  array, cut it into runs), so turning documents into (doc, term, tf) rows
  needs no shuffle. Only corpus-wide statistics (document frequency, corpus
  count) aggregate across rows, and they do so with a map-side partial
  aggregate, so a very frequent term costs one row per task, not one per
  occurrence.
* The vocabulary is a top-k (``vocab_size`` rows). It is materialised, its
  size is measured, and it is broadcast if that is below the session's limit.
* The hashed encoder computes token hashes with native expressions and only
  hands an int array per row to an Arrow UDF that bin-counts the whole batch
  with numpy: no shuffle, no per-row Python loop.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..functions import kernels
from ..functions.text import let, ml_tokens
from ..sources.sinks import cut_lineage
from .topk import top_rows

# Ship the kernel with the UDF instead of requiring this package on workers.
cloudpickle.register_pickle_by_value(kernels)

DEFAULT_VOCAB_SIZE = 5000
EMBED_DIM = 384


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own limit for broadcast tables, in bytes (-1: never)."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def measured_broadcast(df: DataFrame, term_col: str = "term") -> DataFrame:
    """Broadcast a materialised term table if its measured size is below the
    session's broadcast limit; else leave the join to Spark (a shuffle with
    skew handling). Both give the same rows."""
    numbers = 8 * (len(df.columns) - 1) + 32
    size = df.agg(F.coalesce(F.sum(F.octet_length(term_col) + numbers), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(df) if size <= broadcast_limit(df.sparkSession) else df


# ---- per-row term counts ------------------------------------------------------


def term_counts(tokens: Column) -> Column:
    """array<struct<term string, tf int>>: distinct terms of a token array
    with their counts, in term order. Runs entirely in the row: sort, then cut
    the sorted array where the term changes (O(n log n) per row)."""

    def runs(s):
        n = F.size(s)
        # 1-based positions where a run of equal terms ends
        ends = F.filter(
            F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
            lambda i: (i == n) | (F.element_at(s, i) != F.element_at(s, i + 1)),
        )
        return let(
            ends,
            lambda e_arr: F.transform(
                e_arr,
                lambda e, j: F.struct(
                    F.element_at(s, e).alias("term"),
                    (e - F.when(j == 0, F.lit(0)).otherwise(F.element_at(e_arr, j))).cast("int").alias("tf"),
                ),
            ),
        )

    empty = F.array().cast("array<struct<term:string,tf:int>>")
    return let(F.sort_array(tokens), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(empty))


def term_frequency(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf) with ML-tokenizer tokens (empty text -> the empty term)."""
    return df.select(
        F.col(id_col), F.inline(term_counts(ml_tokens(F.col(text_col))))
    )


def vocabulary(tf: DataFrame, vocab_size: int = DEFAULT_VOCAB_SIZE, min_df: int = 1) -> DataFrame:
    """Top ``vocab_size`` terms by corpus count (ties by term): term, n, df, rank.

    ``rank`` is 0-based, like the index ``CountVectorizer`` gives a term. The
    term statistics are written once; histograms of the counts then find the
    last rank (``topk``), so no task merges the best terms of all partitions.
    The rank window sees only the ``vocab_size`` rows that are left.
    """
    stats = tf.groupBy("term").agg(
        F.sum("tf").cast("long").alias("n"), F.count(F.lit(1)).alias("df")
    )
    if min_df > 1:
        stats = stats.where(F.col("df") >= min_df)
    top = top_rows(cut_lineage(tf.sparkSession, stats, "term-stats"), vocab_size, "n", "term")
    return top.withColumn(
        "rank", (F.row_number().over(Window.orderBy(F.desc("n"), "term")) - 1).cast("int")
    )


def idf(vocab: DataFrame, n_docs: Column | int) -> DataFrame:
    """(term, df, idf) with smoothed idf = ln((m + 1) / (df + 1)).

    ``df`` is already in the vocabulary table; ``n_docs`` is the number of
    documents (all of them, also those without a vocabulary term).
    """
    m = n_docs if isinstance(n_docs, Column) else F.lit(int(n_docs))
    return vocab.select(
        "term",
        "df",
        F.log((m.cast("double") + 1.0) / (F.col("df").cast("double") + 1.0)).alias("idf"),
    )


def tfidf(tf: DataFrame, idf_table: DataFrame) -> DataFrame:
    """(id, term, tf, tfidf) for vocabulary terms only. ``idf_table`` is read
    twice (its size, the join): give a materialised one."""
    return tf.join(measured_broadcast(idf_table.select("term", "idf")), "term", "inner").withColumn(
        "tfidf", F.col("tf") * F.col("idf")
    )


# ---- hashed bag-of-words encoder ----------------------------------------------


def hashed_index(tokens: Column, dim: int = EMBED_DIM) -> Column:
    """Per token: bucket = first 8 hex digits of md5 mod ``dim``; sign + when
    the ninth hex digit is below 8. Encoded as +-(bucket + 1), array<int>."""

    def signed(h):
        b = (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % F.lit(dim)).cast("int") + 1
        return F.when(F.substring(h, 9, 1) < F.lit("8"), b).otherwise(-b)

    def one(t):
        return let(F.md5(t), signed)

    return F.transform(tokens, one)


def _make_bincount(dim: int):
    kernel = kernels.signed_bincount_unit

    @arrow_udf("array<double>")
    def bincount_unit(indices: pa.Array) -> pa.Array:
        return kernel(indices, dim)

    return bincount_unit


_BINCOUNT = {}


def hashed_vector(tokens: Column, dim: int = EMBED_DIM) -> Column:
    """Dense, L2-normalised signed-count vector (array<double>, all zeros for
    no tokens)."""
    if dim not in _BINCOUNT:
        _BINCOUNT[dim] = _make_bincount(dim)
    return _BINCOUNT[dim](hashed_index(tokens, dim))


def sparse_entries(dense: Column) -> Column:
    """array<struct<dim int, value double>> of the non-zero entries of a dense array."""
    return F.filter(
        F.transform(dense, lambda v, i: F.struct(i.cast("int").alias("dim"), v.alias("value"))),
        lambda e: e["value"] != F.lit(0.0),
    )


def word2vec_vectors(
    df: DataFrame, tokens_col: str, dim: int = EMBED_DIM, seed: int = 42, out_col: str = "features", min_count: int = 5
):
    """Alternative encoder: Spark ML Word2Vec averaged over a row's tokens. Its
    vocabulary lives on the driver (terms x dim floats): raise ``min_count``
    with the corpus."""
    from pyspark.ml.feature import Word2Vec

    w2v = Word2Vec(vectorSize=dim, minCount=min_count, inputCol=tokens_col, outputCol=out_col, seed=seed)
    model = w2v.fit(df)
    return model.transform(df)


def batch_encoder(make_predict_fn, dim: int, batch_size: int = 256):
    """Hook for an external sentence encoder, loaded once per Python worker and
    fed Arrow batches (``predict_batch_udf``). ``make_predict_fn`` returns a
    function from a numpy array of strings to an (n, dim) float array. The
    result is an encoder for ``embed_texts`` and ``score_texts``; a vector of
    another length than ``dim`` is an error."""
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import ArrayType, FloatType

    udf = predict_batch_udf(make_predict_fn, return_type=ArrayType(FloatType()), batch_size=batch_size)

    def encode(text) -> Column:
        wrong = F.raise_error(F.lit(f"the encoder's vectors must have {dim} components"))
        return let(udf(text), lambda v: F.when(F.size(v) == dim, v).otherwise(wrong.cast("array<float>")))

    return encode
