"""3-D projection of embeddings and the tables behind the embedding charts.

The projection is PCA (Spark ML): the covariance is a d x d matrix built by a
distributed aggregate, so only d^2 numbers reach the driver whatever the row
count, and the result is deterministic up to the sign of each axis.
"""

from __future__ import annotations

import numpy as np
from pyspark import cloudpickle
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.labels import decode_label
from .evaluate import report_counts_columns


# Ship the kernel with the tasks instead of requiring this package on workers.
cloudpickle.register_pickle_by_value(kernels)


def pca_3d(df: DataFrame, features_col: str = "features", k: int = 3) -> DataFrame:
    """Adds x, y, z: the first three principal components. Each axis is turned
    so that its largest loading is positive, so reruns don't mirror it."""
    model = fit_pca(df, features_col, k)
    loadings = model.pc.toArray()  # d x k
    sign = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    arr = vector_to_array(F.col("_pca"))
    axes = [(arr[i] * F.lit(float(sign[i]))).alias(name) for i, name in enumerate("xyz"[:k])]
    return model.transform(df).select(*df.columns, *axes)


def fit_pca(df: DataFrame, features_col: str = "features", k: int = 3):
    return PCA(k=k, inputCol=features_col, outputCol="_pca").fit(df)


def covariance(df: DataFrame, array_col: str) -> DataFrame:
    """``i, j, cov`` (i <= j): sample covariances of the components. Each task
    sums one matrix over its vectors (a matrix product a batch) and sends
    d * (d + 1) / 2 numbers, whatever its rows; the tasks' sums about their own
    means are merged by one aggregate. Null components leave out their pairs;
    a pair with fewer than two rows has no covariance."""
    rows = df.select(F.col(array_col).cast("array<double>").alias("v"))
    parts = rows.mapInArrow(kernels.moment_rows, "i int, j int, n double, mean_i double, mean_j double, product double")
    # means about one task's: large means would cancel
    pair = Window.partitionBy("i", "j")
    about = [(F.col(c) - F.first(c).over(pair)).alias(c) for c in ("mean_i", "mean_j")]
    sums = (
        parts.where("n > 0")
        .select("i", "j", "n", "product", *about)
        .groupBy("i", "j")
        .agg(
            F.sum("n").alias("n"),
            F.sum("product").alias("product"),
            F.sum(F.col("n") * F.col("mean_i")).alias("si"),
            F.sum(F.col("n") * F.col("mean_j")).alias("sj"),
            F.sum(F.col("n") * F.col("mean_i") * F.col("mean_j")).alias("sij"),
        )
    )
    about = F.col("product") + F.col("sij") - F.col("si") * F.col("sj") / F.col("n")
    return sums.select("i", "j", F.when(F.col("n") > 1, about / (F.col("n") - 1)).alias("cov"))


def first_three(df: DataFrame, array_col: str) -> DataFrame:
    """x, y, z from the first three components of an array column."""
    e = F.col(array_col)
    return df.withColumns(
        {"x": e[0].cast("double"), "y": e[1].cast("double"), "z": e[2].cast("double")}
    )


def planar(df: DataFrame, id_col: str, class_col: str) -> DataFrame:
    """Long form of the XY, XZ and YZ projections: one row per point and plane."""
    return df.select(
        F.col(id_col),
        decode_label(F.col(class_col)).alias("sentiment"),
        F.inline(
            F.array(
                F.struct(F.lit("XY").alias("plane"), F.col("x").alias("a"), F.col("y").alias("b")),
                F.struct(F.lit("XZ").alias("plane"), F.col("x").alias("a"), F.col("z").alias("b")),
                F.struct(F.lit("YZ").alias("plane"), F.col("y").alias("a"), F.col("z").alias("b")),
            )
        ),
    )


def embedding_report(df: DataFrame, class_col: str) -> DataFrame:
    """One row: total and per-class counts, population variance and range per
    axis, all in a single aggregate (one pass, one row through the shuffle per task)."""
    named = df.withColumn("sentiment", decode_label(F.col(class_col)))
    return named.agg(
        *report_counts_columns("sentiment"),
        *[F.var_pop(a).alias(f"var_{a}") for a in "xyz"],
        *[(F.max(a) - F.min(a)).alias(f"range_{a}") for a in "xyz"],
    )
