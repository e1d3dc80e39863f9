"""Split and sample invariants."""

from pyspark.sql import functions as F

from tonality.operators.split import exact_sample, train_test_split, with_split

from conftest import SF01


def test_split_is_partition_and_stable(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    train, test = train_test_split(docs, "doc_id")
    n, a, b = docs.count(), train.count(), test.count()
    assert a + b == n
    assert train.join(test, "doc_id").count() == 0
    assert 0.7 < a / n < 0.9
    again = with_split(docs.repartition(5), "doc_id").where("split = 'test'").select("doc_id")
    assert sorted(r[0] for r in again.collect()) == sorted(r[0] for r in test.collect())


def test_sample_exact_and_layout_free(spark):
    e = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id")
    for k in (10, 3000):
        s1 = [r[0] for r in exact_sample(e, "vec_id", k).collect()]
        s2 = [r[0] for r in exact_sample(e.repartition(7), "vec_id", k).collect()]
        assert len(s1) == min(k, e.count())
        assert sorted(s1) == sorted(s2)
        assert len(set(s1)) == len(s1)


def test_random_split_option_is_a_partition(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    train, test = train_test_split(docs, "doc_id", method="random")
    assert train.count() + test.count() == docs.count()
    assert train.join(test, "doc_id").count() == 0


def test_threshold_sample_equals_plain_top_k(spark):
    from tonality.operators.split import hash_key

    e = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id")
    for k in (1, 10, 100):
        fast = sorted(r[0] for r in exact_sample(e, "vec_id", k).collect())
        plain = e.withColumn("h", hash_key(F.col("vec_id"), 42)).orderBy("h", "vec_id").limit(k)
        assert fast == sorted(r[0] for r in plain.collect())


def test_copies_are_dealt_row_by_row(spark):
    """Half of the rows are one comment: by row id its share in the sample and
    the split is that of all rows; by content id it stays together."""
    rows = spark.range(0, 20000, numPartitions=8).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") + 100).alias("content_id")
    )
    copies = exact_sample(rows, "row_id", 3000).where("content_id = 7").count()
    assert abs(copies - 1500) < 4 * (3000 * 0.25) ** 0.5
    train, test = train_test_split(rows, "row_id")
    assert abs(train.count() - 16000) < 300
    assert abs(train.where("content_id = 7").count() - 8000) < 200
    train, test = train_test_split(rows, "content_id")
    assert 0 in (train.where("content_id = 7").count(), test.where("content_id = 7").count())
