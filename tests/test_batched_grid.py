"""The batched grid against Spark's own fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonality.operators import models
from tonality.operators.batched_grid import grid_search_batched
from tonality.operators.split import bucket

GRID = {"regParam": [0.02, 0.3], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [5, 200]}


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(0, 1, (3, 6))
    label = rng.integers(0, 3, 400)
    x = centre[label] + rng.normal(0, 1.5, (400, 6)) * [1, 1, 10, 0.1, 1, 1] + [0, 50, 0, 0, 0, 0]
    x[:, 5] = 2.5  # a constant feature
    rows = [(i, [float(v) for v in x[i]], int(label[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, label int")
    return models.as_vector(df, "embedding").cache()


def test_coefficients_equal_single_fits(spark, train):
    ranked, fits = grid_search_batched(spark, train, "id", grid=GRID)
    assert fits.residual.max() < 1e-6
    w, b = fits.read[200]
    dealt = train.withColumn("f", bucket(F.col("id"), models.SEED + 1, 3))
    for i in range(0, len(fits.reg), 2):
        one = models.train_logreg(dealt.where(F.col("f") != int(fits.fold[i])), regParam=float(fits.reg[i]),
                                  elasticNetParam=float(fits.net[i]), maxIter=300, tol=1e-10)
        assert np.abs(one.coefficientMatrix.toArray().T - w[i]).max() < 1e-4
        assert np.abs(one.interceptVector.toArray() - (b[i] - b[i].mean())).max() < 1e-3
    early, _ = fits.read[5]
    assert np.abs(early - w).max() > 1e-6  # a small maxIter is read on the way


def test_ranking_equals_the_grid_search(spark, train):
    grid = GRID | {"maxIter": [200]}
    ours, _ = grid_search_batched(spark, train, "id", grid=grid)
    theirs, _, _, _ = models.grid_search(spark, train, train, "id", grid=grid)
    columns = ["rank", "accuracy", "regParam", "elasticNet", "maxIter"]
    a, b = ([tuple(r) for r in df.select(*columns).orderBy("rank").collect()] for df in (ours, theirs))
    assert [r[2:] for r in a] == [r[2:] for r in b]
    assert max(abs(x[1] - y[1]) for x, y in zip(a, b)) < 1e-9


def test_two_classes_and_odd_vectors_are_errors(spark, train):
    with pytest.raises(ValueError, match="two classes"):
        grid_search_batched(spark, train.where("label < 2"), "id", grid=GRID)
    odd = train.withColumn("embedding", F.when(F.col("id") == 7, F.array(F.lit(1.0))).otherwise(F.col("embedding")))
    with pytest.raises(Exception, match="same length"):
        grid_search_batched(spark, odd, "id", grid=GRID)
