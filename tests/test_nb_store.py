"""Naive Bayes from stored statistics: batches add up to one model."""

import pytest
from pyspark.sql import functions as F

from tonality.operators import naive_bayes, nb_store

ROWS = [(i, ["bad film", "good good film", "so so", "", "film film noir"][i % 5], i % 3) for i in range(60)]


def rows_of(model):
    return sorted((r["label"], r["term"], round(r["prior"], 12), round(r["theta"], 12)) for r in naive_bayes.model_table(model).collect())


@pytest.fixture
def train(spark):
    return spark.createDataFrame(ROWS, "doc_id long, processed_comment string, label int")


def test_batches_in_any_order_give_the_model_of_all_rows(spark, train, tmp_dir):
    whole = rows_of(naive_bayes.fit(train, "doc_id"))
    parts = [train.where(F.col("doc_id") % 3 == k) for k in range(3)]  # each batch is one class only
    for name, order in (("a", (0, 1, 2)), ("b", (2, 0, 1))):
        for k in order:
            nb_store.update(spark, f"{tmp_dir}/{name}", parts[k], f"part {k}")
        assert rows_of(nb_store.fit_stored(spark, f"{tmp_dir}/{name}")) == whole


def test_a_repeated_batch_and_an_unfinished_version_change_nothing(spark, train, tmp_dir):
    assert nb_store.update(spark, tmp_dir, train, "all") == 1
    first = rows_of(nb_store.fit_stored(spark, tmp_dir))
    assert nb_store.update(spark, tmp_dir, train, "all") == 1
    spark.range(3).write.parquet(f"{tmp_dir}/v2/terms")  # a job that died before its commit
    assert nb_store.versions(spark, tmp_dir) == [1]
    assert rows_of(nb_store.fit_stored(spark, tmp_dir)) == first
    assert nb_store.update(spark, tmp_dir, train.limit(0), "nothing") == 2
    assert rows_of(nb_store.fit_stored(spark, tmp_dir)) == first
    assert nb_store.update(spark, tmp_dir, train, "all") == 2


def test_old_versions_stay_and_missing_ones_are_an_error(spark, train, tmp_dir):
    nb_store.update(spark, tmp_dir, train.where("doc_id < 30"), "first")
    nb_store.update(spark, tmp_dir, train.where("doc_id >= 30"), "second")
    assert rows_of(nb_store.fit_stored(spark, tmp_dir, 1)) == rows_of(naive_bayes.fit(train.where("doc_id < 30"), "doc_id"))
    with pytest.raises(ValueError, match="no committed version 5"):
        nb_store.fit_stored(spark, tmp_dir, 5)
    with pytest.raises(ValueError, match="class labels"):
        nb_store.update(spark, tmp_dir, train.withColumn("label", F.lit(-1)), "wrong")
