"""Spark ML models on feature vectors: logistic regression, random forest,
the TF-IDF + Naive Bayes pipeline, and a cross-validated grid search.

Dimension and class count come from the data (vector size, label values);
nothing assumes 384 features or 3 classes. Training input is persisted for
the duration of a fit, because each optimiser iteration rescans it.
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from itertools import product

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, CountVectorizer, CountVectorizerModel, Tokenizer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .evaluate import accuracy
from .split import bucket

# --- fixed values: model settings of the pipeline being re-expressed -----------
LR_PARAMS = {"maxIter": 20, "regParam": 0.01}
RF_PARAMS = {"numTrees": 100, "maxDepth": 5}
NB_PIPELINE = {"vocabSize": 5000, "smoothing": 1.0}
GRID = {"regParam": [0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0], "maxIter": [50, 100]}
GRID_FOLDS = 3
# -------------------------------------------------------------------------------

SEED = 42


def as_vector(df: DataFrame, array_col: str, out_col: str = "features") -> DataFrame:
    """array<float|double> -> ML dense vector (native expression). The array
    column stays; a plan that doesn't use it drops it."""
    return df.withColumn(out_col, array_to_vector(F.col(array_col).cast("array<double>")))


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist for the duration of a fit. A lost cached block is recomputed
    from lineage, so this stays correct when executors go away."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def train_logreg(train: DataFrame, label_col: str = "label", features_col: str = "features", **params):
    conf = dict(LR_PARAMS)
    conf.update(params)
    lr = LogisticRegression(labelCol=label_col, featuresCol=features_col, **conf)
    return lr.fit(train)


def train_forest(train: DataFrame, label_col: str = "label", features_col: str = "features", seed: int = SEED, **params):
    conf = dict(RF_PARAMS)
    conf.update(params)
    rf = RandomForestClassifier(labelCol=label_col, featuresCol=features_col, seed=seed, **conf)
    return rf.fit(train)


def nb_pipeline(
    text_col: str = "processed_comment",
    label_col: str = "label",
    vocab_size: int | None = None,
    smoothing: float | None = None,
    vocabulary: list[str] | None = None,
) -> Pipeline:
    """Tokenizer -> CountVectorizer -> IDF -> NaiveBayes(multinomial).

    ``CountVectorizer`` leaves open which of the terms tied at the last place
    of the vocabulary it keeps; a given ``vocabulary`` (at most ``vocab_size``
    terms, in order) settles it."""
    size = NB_PIPELINE["vocabSize"] if vocab_size is None else vocab_size
    if vocabulary is None:
        counts = CountVectorizer(inputCol="words", outputCol="tf", vocabSize=size, minDF=1.0, minTF=1.0)
    else:
        counts = CountVectorizerModel.from_vocabulary(vocabulary[:size], "words", "tf", minTF=1.0)
    lam = NB_PIPELINE["smoothing"] if smoothing is None else smoothing
    return Pipeline(
        stages=[
            Tokenizer(inputCol=text_col, outputCol="words"),
            counts,
            IDF(inputCol="tf", outputCol="tfidf", minDocFreq=0),
            NaiveBayes(featuresCol="tfidf", labelCol=label_col, smoothing=lam, modelType="multinomial"),
        ]
    )


def compare_models(models: dict, test: DataFrame, label_col: str = "label") -> DataFrame:
    """One row per model: name, n, accuracy, on the same test rows."""
    parts = []
    for name, model in models.items():
        parts.append(
            accuracy(model.transform(test), label_col).select(F.lit(name).alias("model"), "n", "accuracy")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def grid_search(
    spark: SparkSession,
    train: DataFrame,
    test: DataFrame,
    id_col: str,
    label_col: str = "label",
    features_col: str = "features",
    grid: dict | None = None,
    folds: int = GRID_FOLDS,
    parallelism: int | None = None,
    seed: int = SEED,
):
    """Cross-validated grid over logistic regression.

    Returns (ranked table, best model, summary, wall seconds). The ranked
    table is rank, accuracy, regParam, elasticNet, maxIter, by mean fold
    accuracy with ties in the order of the parameters. The summary is one row:
    the best set, its fold accuracy, and its accuracy on the test rows.

    A row's fold is an md5 bucket of its id, so the folds are the same however
    the rows are laid out. Only id, label, features and fold are persisted.
    """
    grid = grid or GRID
    if parallelism is None:
        # each fit is a chain of small jobs; run as many fits at once as there
        # are cores (up to 16 driver threads)
        parallelism = max(1, min(16, spark.sparkContext.defaultParallelism, grid_size(grid)))
    lr = LogisticRegression(labelCol=label_col, featuresCol=features_col)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(getattr(lr, name), values)
    maps = builder.build()
    evaluator = MulticlassClassificationEvaluator(labelCol=label_col, predictionCol="prediction", metricName="accuracy")
    cv = CrossValidator(
        estimator=lr, estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, parallelism=parallelism, seed=seed, foldCol="_fold"
    )
    dealt = train.select(id_col, label_col, features_col, bucket(F.col(id_col), seed + 1, folds).alias("_fold"))
    start = time.time()
    with persisted(dealt):
        cv_model = cv.fit(dealt)
    seconds = time.time() - start
    rows = []
    for pm, metric in zip(maps, cv_model.avgMetrics, strict=True):
        vals = {p.name: v for p, v in pm.items()}
        rows.append((float(metric), float(vals.get("regParam", 0.0)), float(vals.get("elasticNetParam", 0.0)), int(vals.get("maxIter", 100))))
    # a small table (one row per parameter set), built from model metadata
    table = spark.createDataFrame(rows, "accuracy double, regParam double, elasticNet double, maxIter int")
    order = Window.orderBy(F.desc("accuracy"), "regParam", "elasticNet", "maxIter")
    ranked = table.select(F.row_number().over(order).alias("rank"), "accuracy", "regParam", "elasticNet", "maxIter")
    best = cv_model.bestModel
    on_test = accuracy(best.transform(test), label_col).select(F.col("n").alias("test_n"), F.col("accuracy").alias("test_accuracy"))
    chosen = {"regParam": best.getRegParam(), "elasticNet": best.getElasticNetParam(), "maxIter": best.getMaxIter()}
    summary = on_test.select(
        *[F.lit(v).alias(k) for k, v in chosen.items()], F.lit(float(max(cv_model.avgMetrics))).alias("cv_accuracy"), "test_n", "test_accuracy"
    )
    return ranked, best, summary, seconds


def grid_size(grid: dict | None = None) -> int:
    grid = grid or GRID
    return len(list(product(*grid.values())))
