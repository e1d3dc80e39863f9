"""A distance-preserving 3-D view: landmark scaling with an extension to every row.

PCA shortens distances: what lies outside of the three axes is lost. Here

1. landmarks are chosen by the farthest-point rule from an exact sample
   (``SAMPLE`` rows, ``LANDMARKS`` of them: both are parameters and bound what
   the driver sees);
2. the landmarks are placed by classical scaling (double-centred squared
   distances), and moved by stress majorisation until their distances in three
   dimensions fit the true ones;
3. every row is placed by its distances to the landmarks, inside the tasks: the
   Nystroem extension of the classical solution, then majorisation steps against
   the fixed landmarks. A batch is a few matrix products; nothing is shuffled.

The result is deterministic up to the sample's hash order; each axis is turned
so that its largest landmark coordinate is positive.

Defined results: a null vector, or one with nulls, gets null coordinates; with
fewer than two distinct sampled vectors all points are at the origin; vectors
of another length than the first sampled one are an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .split import exact_sample

# The task-side functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE, LANDMARKS, AXES = 3000, 150, 3
LANDMARK_STEPS, ROW_STEPS = 300, 30


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squared = (x**2).sum(axis=1)[:, None] + (y**2).sum(axis=1)[None, :] - 2 * x @ y.T
    return np.sqrt(np.maximum(squared, 0))


def farthest_points(x: np.ndarray, k: int) -> np.ndarray:
    """Up to k rows, each the farthest from those before; the first is the
    farthest from the mean. Repeated rows are taken once."""
    near = distances(x, x.mean(axis=0, keepdims=True))[:, 0]
    chosen = [int(near.argmax())]
    near = distances(x, x[chosen])[:, 0]
    while len(chosen) < min(k, len(x)) and near.max() > 1e-9:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    return np.array(chosen)


def _pull(place: np.ndarray, target: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """One majorisation step: where the targets, each at its wanted distance in
    the present direction, would have each point on average."""
    now = distances(place, target)
    ratio = np.divide(wanted, now, out=np.zeros_like(now), where=now > 1e-12)
    return target.mean(axis=0) + (ratio.sum(axis=1)[:, None] * place - ratio @ target) / len(target)


def place_landmarks(wanted: np.ndarray, axes: int = AXES) -> tuple[np.ndarray, np.ndarray]:
    """(coordinates, extension matrix) of landmarks with the given distances."""
    squared = wanted**2
    centred = -0.5 * (squared - squared.mean(axis=0) - squared.mean(axis=1)[:, None] + squared.mean())
    size, vector = np.linalg.eigh(centred)
    size, vector = size[::-1][:axes], vector[:, ::-1][:, :axes]
    kept = size > 1e-9 * max(size.max(initial=0), 1e-300)
    root = np.sqrt(np.where(kept, size, 0))
    place = vector * root
    extension = np.divide(vector, root, out=np.zeros_like(vector), where=root > 0)
    for _ in range(LANDMARK_STEPS):
        place = _pull(place, place, wanted)
        place -= place.mean(axis=0)
    sign = np.sign(place[np.abs(place).argmax(axis=0), np.arange(place.shape[1])])
    sign = np.where(sign == 0, 1, sign)
    return np.pad(place * sign, ((0, 0), (0, axes - place.shape[1]))), np.pad(extension * sign, ((0, 0), (0, axes - extension.shape[1])))


def place_rows(x: np.ndarray, landmark: np.ndarray, place: np.ndarray, extension: np.ndarray, mean_squared: np.ndarray) -> np.ndarray:
    wanted = distances(x, landmark)
    out = -0.5 * (wanted**2 - mean_squared) @ extension
    for _ in range(ROW_STEPS):
        out = _pull(out, place, wanted)
    return out


def _place_task(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        landmark, place, extension, mean_squared = shared.value
        for batch in batches:
            lists = batch.column("v")
            whole = lists.is_valid().to_numpy(zero_copy_only=False)
            x = np.full((batch.num_rows, landmark.shape[1]), np.nan)
            flat = lists.filter(pa.array(whole)).flatten().to_numpy(zero_copy_only=False)
            x[whole] = flat.reshape(int(whole.sum()), landmark.shape[1])
            whole &= ~np.isnan(x).any(axis=1)
            xyz = np.full((batch.num_rows, place.shape[1]), np.nan)
            if whole.any():
                xyz[whole] = place_rows(x[whole], landmark, place, extension, mean_squared) if len(landmark) > 1 else 0.0
            columns = [pa.array(c, pa.float64(), mask=~whole) for c in xyz.T]
            yield pa.RecordBatch.from_arrays([batch.column("rest"), *columns], ["rest", *"xyz"[: place.shape[1]]])

    return run


def landmark_3d(df: DataFrame, id_col: str, array_col: str = "embedding", landmarks: int = LANDMARKS, sample: int = SAMPLE) -> DataFrame:
    """``df`` with x, y, z (columns of these names are replaced)."""
    vector = F.col(array_col).cast("array<double>")
    usable = df.select(id_col, vector.alias("v")).where("v IS NOT NULL AND NOT exists(v, c -> c IS NULL)")
    rows = [r["v"] for r in exact_sample(usable, id_col, sample).collect()]  # at most ``sample`` rows
    x = np.array(rows, float).reshape(len(rows), -1) if rows else np.zeros((0, 0))
    landmark = x[farthest_points(x, landmarks)] if len(x) else x
    wanted = distances(landmark, landmark)
    place, extension = place_landmarks(wanted) if len(landmark) > 1 else (np.zeros((len(landmark), AXES)),) * 2
    shared = df.sparkSession.sparkContext.broadcast((landmark, place, extension, (wanted**2).mean(axis=0) if len(landmark) else np.zeros(0)))
    keep = [c for c in df.columns if c not in "xyz"]
    source = df.select(F.struct(*keep).alias("rest"), vector.alias("v"))
    schema = StructType([source.schema["rest"], *[StructField(a, DoubleType()) for a in "xyz"]])
    return source.mapInArrow(_place_task(shared), schema).select("rest.*", "x", "y", "z")


def stress(df: DataFrame, id_col: str, array_col: str, n: int = 400, seed: int = 7) -> float:
    """How far distances in x, y, z are from the true ones: root of the squared
    differences over the squared distances, over all pairs of an exact sample of
    n rows (the sample is the feature)."""
    rows = exact_sample(df.select(id_col, F.col(array_col).alias("v"), F.array(*"xyz").alias("p")), id_col, n, seed).collect()
    true, seen = (distances(m, m) for m in (np.array([r["v"] for r in rows], float), np.array([r["p"] for r in rows], float)))
    return float(np.sqrt(((true - seen) ** 2).sum() / (true**2).sum()))
