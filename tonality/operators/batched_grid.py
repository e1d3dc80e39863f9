"""Cross-validated grid search in one scan per iteration for all models.

``CrossValidator`` fits every parameter set on every fold by itself: 54 fits,
each with a scan per iteration. Here the weights of all models stand side by
side in one matrix, so a pass over the rows is one matrix product a batch, and
one aggregate sums the gradients of all models (folds x sets x classes columns).

Objective: that of the multinomial ``LogisticRegression`` with standardisation:
mean log loss + reg * ((1 - net) / 2 * |b|^2 + net * |b|_1) on the coefficients
of features scaled to unit standard deviation; intercepts are not penalised.

Steps. The Hessian of the log loss is at most half the second moments of the
features, for every class (Boehning's bound). Those moments are summed once per
fold, so a step solves a fixed quadratic problem on the driver (d x d numbers,
whatever the rows): in closed form for a squared penalty, by an accelerated
proximal loop with an absolute one. Steps start
a little ahead of the last point (Nesterov's momentum, started anew for a path
that overshoots).

A set's ``maxIter`` says when its path is read: sets that differ only there
share a path. Paths end when no coefficient moves by more than ``TOLERANCE``.

Defined results: rows whose label or vector is null, or whose vector has
another length than the first, are an error; a constant feature gets no weight;
classes are 0 to the largest label, at least three (for two classes Spark's
model has another objective: use ``grid_search``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .models import GRID, GRID_FOLDS, SEED, persisted
from .split import bucket

# The task-side functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOLERANCE = 1e-8
BATCH_ROWS = 4096


@dataclass
class FittedGrid:
    """One entry per path (parameter set without maxIter, and fold)."""

    reg: np.ndarray
    net: np.ndarray
    fold: np.ndarray
    read: dict[int, tuple[np.ndarray, np.ndarray]]  # maxIter -> (coefficients m x d x k, intercepts m x k)
    residual: np.ndarray  # how far each path's end is from the optimality conditions
    iterations: int


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if column.null_count or len(flat) % max(1, len(column)) or np.isnan(flat).any():
        raise ValueError("every row needs a vector of the same length without nulls")
    return flat.reshape(len(column), -1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(at, BATCH_ROWS)
            yield _matrix(part.column("v")), part.column("label").to_numpy(), part.column("fold").to_numpy()


def _sums(values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(values.size)), pa.array(values.ravel())], ["place", "value"])


def _total(rows: DataFrame, run) -> np.ndarray:
    """The sum of the arrays that the tasks return (as many numbers as one)."""
    sums = rows.mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(sums.num_rows)
    out[sums["place"].to_numpy()] = sums["value"].to_numpy()
    return out


def _moment_task(folds: int):
    def run(batches):
        total = None
        for x, _, fold in _parts(batches):
            one = np.hstack([x, np.ones((len(x), 1))])
            if total is None:
                total = np.zeros((folds, one.shape[1], one.shape[1]))
            for f in range(folds):
                own = one[fold == f]
                total[f] += own.T @ own
        if total is not None:
            yield _sums(total)

    return run


def _errors(x: np.ndarray, label: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability minus truth, per row, model and class."""
    m, _, k = w.shape
    logits = (x @ w.transpose(1, 0, 2).reshape(x.shape[1], m * k)).reshape(len(x), m, k) + b
    logits -= logits.max(axis=2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=2, keepdims=True)
    logits[np.arange(len(x)), :, label] -= 1
    return logits


def _gradient_task(shared):
    def run(batches):
        w, b, own_fold = shared.value
        m, d, k = w.shape
        total = np.zeros((d + 1, m * k))
        for x, label, fold in _parts(batches):
            e = _errors(x, label, w, b) * (fold[:, None] != own_fold[None, :])[:, :, None]
            e = e.reshape(len(x), m * k)
            total[:d] += x.T @ e
            total[d] += e.sum(axis=0)
        yield _sums(total)

    return run


def _hits_task(shared):
    def run(batches):
        w, b, own_fold = shared.value
        hits = np.zeros((2, len(w)))
        for x, label, fold in _parts(batches):
            m, d, k = w.shape
            best = ((x @ w.transpose(1, 0, 2).reshape(d, m * k)).reshape(len(x), m, k) + b).argmax(axis=2)
            held = fold[:, None] == own_fold[None, :]
            hits += [(held & (best == label[:, None])).sum(axis=0), held.sum(axis=0)]
        yield _sums(hits)

    return run


def _shrink(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - by, 0)


def _best_step(beta, g, gram, ridge, lasso):
    """argmin over new of <g, new - beta> + (new - beta)' gram (new - beta) / 2 +
    ridge/2 |new|^2 + lasso |new|_1, for all paths (m x d x k) at once."""
    d = beta.shape[1]
    system = gram + ridge[:, None, None] * np.eye(d)
    right = np.matmul(gram, beta) - g
    free = np.linalg.solve(system + 1e-12 * np.eye(d), right)
    if not lasso.any():
        return free
    rate = 1 / np.linalg.eigvalsh(system)[:, -1][:, None, None].clip(1e-12)
    cut = lasso[:, None, None] * rate
    now = ahead = np.where(lasso[:, None, None] > 0, beta, free)
    t = 1.0
    for _ in range(2000):
        new = _shrink(ahead - rate * (np.matmul(system, ahead) - right), cut)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        moved = np.abs(new - now).max()
        ahead, now, t = new + (t - 1) / t_new * (new - now), new, t_new
        if moved < TOLERANCE / 10:
            break
    return np.where(lasso[:, None, None] > 0, now, free)


def _residual(beta, g, g_b, ridge, lasso) -> np.ndarray:
    """The largest violation of the optimality conditions, per path."""
    slope = g + ridge[:, None, None] * beta
    at_zero = np.maximum(np.abs(slope) - lasso[:, None, None], 0)
    off_zero = np.abs(slope + lasso[:, None, None] * np.sign(beta))
    return np.maximum(np.where(beta == 0, at_zero, off_zero).max(axis=(1, 2)), np.abs(g_b).max(axis=1))


def fit_grid(rows: DataFrame, classes: int, folds: int, grid: dict) -> FittedGrid:
    """Fit all paths over ``v`` (array of double), ``label``, ``fold`` (int)."""
    spark = rows.sparkSession
    own = np.array(list(product(grid["regParam"], grid["elasticNetParam"], range(folds))))
    reg, net, fold = own[:, 0], own[:, 1], own[:, 2].astype(int)
    ridge, lasso, m, k = reg * (1 - net), reg * net, len(own), classes

    moments = _total(rows, _moment_task(folds))
    size = int(round((len(moments) / folds) ** 0.5))
    moments = moments.reshape(folds, size, size)
    learn = moments.sum(axis=0)[None] - moments  # of the rows outside of each fold
    d = size - 1
    n = learn[:, d, d]
    mean = learn[:, d, :d] / n[:, None]
    cov = learn[:, :d, :d] / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    sd = np.sqrt(np.maximum(np.diagonal(cov, axis1=1, axis2=2) * (n / (n - 1))[:, None], 0))
    scale = np.divide(1, sd, out=np.zeros_like(sd), where=sd > 1e-12)  # a constant feature: no weight
    gram = 0.5 * (cov * scale[:, :, None] * scale[:, None, :])[fold]

    beta, b = np.zeros((m, d, k)), np.zeros((m, k))
    read: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def outside(beta, b) -> tuple[np.ndarray, np.ndarray]:
        """Weights and intercepts for the features as they are."""
        w = beta * scale[fold][:, :, None]
        return w, b - np.einsum("md,mdk->mk", mean[fold], w)

    def slopes(beta, b) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the mean log loss of all paths: one scan."""
        sent = spark.sparkContext.broadcast((*outside(beta, b), fold))  # all weights: paths x d x classes
        total = _total(rows, _gradient_task(sent)).reshape(size, m, k)
        sent.destroy()
        g_b = total[d] / n[fold][:, None]
        g = total[:d].transpose(1, 0, 2) / n[fold][:, None, None]
        return (g - mean[fold][:, :, None] * g_b[:, None, :]) * scale[fold][:, :, None], g_b

    last, steps = max(grid["maxIter"]), 0
    ahead, ahead_b, t = beta, b, np.ones(m)  # where the next step starts: a little further on
    while steps < last:
        g, g_b = slopes(ahead, ahead_b)
        new, new_b = _best_step(ahead, g, gram, ridge, lasso), ahead_b - 2 * g_b
        go, go_b = new - beta, new_b - b
        back = np.einsum("mdk,mdk->m", ahead - new, go) + np.einsum("mk,mk->m", ahead_b - new_b, go_b) > 0
        t = np.where(back, 1.0, t)  # the momentum of a path that overshoots starts anew
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        momentum = (t - 1) / t_new
        ahead, ahead_b = new + momentum[:, None, None] * go, new_b + momentum[:, None] * go_b
        beta, b, t, steps = new, new_b, t_new, steps + 1
        if steps in grid["maxIter"]:
            read[steps] = outside(beta, b)
        if max(np.abs(go).max(), np.abs(go_b).max()) < TOLERANCE:
            break
    residual = _residual(beta, *slopes(beta, b), ridge, lasso)
    end = outside(beta, b)
    read |= {limit: end for limit in grid["maxIter"] if limit not in read}
    return FittedGrid(reg, net, fold, read, residual, steps)


def grid_search_batched(
    spark: SparkSession,
    train: DataFrame,
    id_col: str,
    label_col: str = "label",
    array_col: str = "embedding",
    grid: dict | None = None,
    folds: int = GRID_FOLDS,
    seed: int = SEED,
) -> tuple[DataFrame, FittedGrid]:
    """(ranked table, fits), the folds being those of ``grid_search``: rank,
    accuracy, regParam, elasticNet, maxIter, residual (the worst of the folds)."""
    grid = grid or GRID
    rows = train.select(
        F.col(array_col).cast("array<double>").alias("v"),
        F.col(label_col).cast("int").alias("label"),
        bucket(F.col(id_col), seed + 1, folds).alias("fold"),
    )
    with persisted(rows):
        classes = rows.agg(F.max("label")).first()[0] + 1
        if classes < 3:
            raise ValueError("two classes have another objective; use grid_search")
        fits = fit_grid(rows, classes, folds, grid)
        limits = grid["maxIter"]
        w = np.concatenate([fits.read[i][0] for i in limits])
        b = np.concatenate([fits.read[i][1] for i in limits])
        sent = spark.sparkContext.broadcast((w, b, np.tile(fits.fold, len(limits))))
        hits = _total(rows, _hits_task(sent)).reshape(2, len(limits), -1, folds)
        sent.destroy()
    share = (hits[0] / np.maximum(hits[1], 1)).mean(axis=2)  # limits x sets
    worst = fits.residual.reshape(-1, folds).max(axis=1)
    sets = list(product(grid["regParam"], grid["elasticNetParam"]))
    out = [
        (float(share[j, i]), float(reg), float(net), int(limit), float(worst[i]))
        for i, (reg, net) in enumerate(sets)
        for j, limit in enumerate(limits)
    ]
    table = spark.createDataFrame(out, "accuracy double, regParam double, elasticNet double, maxIter int, residual double")
    order = Window.orderBy(F.desc("accuracy"), "regParam", "elasticNet", "maxIter")
    return table.select(F.row_number().over(order).alias("rank"), *table.columns), fits
