"""Spark ML models on embeddings: LR parity, forest seed, grid, projection."""

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tonality.operators import models, projection
from tonality.plans.catalog import embedding_rows, embedding_split

from conftest import SF01


def test_lr_prediction_is_argmax(spark):
    train, test = embedding_split(spark, SF01)
    lr = models.train_logreg(train)
    w, b = lr.coefficientMatrix.toArray(), lr.interceptVector.toArray()
    rows = lr.transform(test).select(vector_to_array("features").alias("f"), "prediction").collect()
    for r in rows:
        assert float(np.argmax(w @ np.array(r["f"]) + b)) == r["prediction"]


def test_forest_is_reproducible(spark):
    """The seed is always explicit, so the same input gives the same forest
    (bootstrap sampling is per partition, so the input layout is part of
    "the same input")."""
    train, test = embedding_split(spark, SF01)
    a = models.train_forest(train, numTrees=10).transform(test).select("vec_id", "prediction").collect()
    b = models.train_forest(train, numTrees=10).transform(test).select("vec_id", "prediction").collect()
    assert sorted(a) == sorted(b)


def test_small_grid_ranks(spark):
    train, test = embedding_split(spark, SF01)
    grid = {"regParam": [0.01, 1.0], "elasticNetParam": [0.0], "maxIter": [10]}
    ranked, best, summary, secs = models.grid_search(spark, train, test, "vec_id", grid=grid, folds=2, parallelism=2)
    rows = ranked.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2]
    assert rows[0]["accuracy"] >= rows[1]["accuracy"]
    top = summary.first()
    assert 0.0 <= top["test_accuracy"] <= 1.0 and top["test_n"] == test.count()
    assert (top["regParam"], top["cv_accuracy"]) == (rows[0]["regParam"], rows[0]["accuracy"])
    # the folds depend on the ids, not on the layout
    again, _, _, _ = models.grid_search(spark, train.repartition(7), test, "vec_id", grid=grid, folds=2, parallelism=2)
    other = again.orderBy("rank").collect()
    assert [r["regParam"] for r in other] == [r["regParam"] for r in rows]
    assert np.allclose([r["accuracy"] for r in other], [r["accuracy"] for r in rows], atol=0.01)


def test_pca_projection_shape(spark):
    e = embedding_rows(spark, SF01)
    p = projection.pca_3d(e)
    assert p.count() == e.count()
    assert {"x", "y", "z"} <= set(p.columns)
    assert p.where(F.col("x").isNull()).count() == 0


def test_pca_axes_have_a_fixed_sign_and_match_numpy(spark):
    e = embedding_rows(spark, SF01)
    rows = projection.pca_3d(e).select("embedding", "x", "y", "z").collect()
    data = np.array([r["embedding"] for r in rows], float)
    _, vectors = np.linalg.eigh(np.cov(data.T))
    top = vectors[:, ::-1][:, :3]
    top = top * np.sign(top[np.abs(top).argmax(axis=0), range(3)])
    assert np.allclose(data @ top, [[r["x"], r["y"], r["z"]] for r in rows], atol=1e-6)


def test_covariance_equals_numpy(spark):
    data = np.random.default_rng(0).normal(size=(30, 4))
    df = spark.createDataFrame([([float(v) for v in r],) for r in data], "e array<double>")
    got = {(r["i"], r["j"]): r["cov"] for r in projection.covariance(df, "e").collect()}
    cov = np.cov(data.T)
    assert set(got) == {(i, j) for i in range(4) for j in range(i, 4)}
    assert all(abs(v - cov[k]) < 1e-12 for k, v in got.items())


def test_covariance_with_nulls_lengths_and_large_means(spark):
    import numpy as np

    from tonality.operators.projection import covariance

    rng = np.random.default_rng(4)
    x = rng.normal(1e6, 1, (500, 5))
    rows = [[None if rng.random() < 0.1 else float(v) for v in row][: 5 - (i % 7 == 0)] for i, row in enumerate(x)] + [None, []]
    df = spark.createDataFrame([(r,) for r in rows], "v array<double>").repartition(6)
    got = {(r["i"], r["j"]): r["cov"] for r in covariance(df, "v").collect()}
    full = np.array([[np.nan if r is None or k >= len(r) or r[k] is None else r[k] for k in range(5)] for r in rows])
    for i in range(5):
        for j in range(i, 5):
            both = ~np.isnan(full[:, i]) & ~np.isnan(full[:, j])
            assert abs(got[i, j] - np.cov(full[both, i], full[both, j])[0, 1]) < 1e-6
    assert covariance(df.limit(0), "v").collect() == []
    assert [r["cov"] for r in covariance(df.where("size(v) = 5").limit(1), "v").collect()] in ([None] * 15, [None] * 10, [None] * 6)
