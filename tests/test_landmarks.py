"""The landmark view: exact where three axes suffice, better than PCA elsewhere."""

import numpy as np

from tonality.operators import landmarks as L
from tonality.operators.models import as_vector
from tonality.operators.projection import pca_3d


def frame(spark, x):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id long, embedding array<double>").repartition(5)


def test_points_of_three_dimensions_keep_all_distances(spark):
    rng = np.random.default_rng(1)
    low = rng.normal(0, 2, (200, 3))
    x = low @ np.linalg.qr(rng.normal(0, 1, (10, 3)))[0].T + 5
    out = L.landmark_3d(frame(spark, x), "id", landmarks=40).orderBy("id").collect()
    xyz = np.array([[r["x"], r["y"], r["z"]] for r in out])
    assert np.abs(L.distances(xyz, xyz) - L.distances(low, low)).max() < 1e-3


def test_distances_are_kept_better_than_by_pca(spark):
    rng = np.random.default_rng(2)
    df = frame(spark, rng.normal(0, 1, (600, 20)))
    ours = L.stress(L.landmark_3d(df, "id"), "id", "embedding")
    assert ours < 0.8 * L.stress(pca_3d(as_vector(df, "embedding")), "id", "embedding")


def test_same_result_on_any_layout(spark):
    rng = np.random.default_rng(4)
    df = frame(spark, rng.normal(0, 1, (120, 8)))
    a, b = (np.array([[r["x"], r["y"], r["z"]] for r in L.landmark_3d(d, "id", landmarks=30).orderBy("id").collect()]) for d in (df, df.coalesce(1)))
    assert np.abs(a - b).max() < 1e-9


def test_nulls_repeats_and_small_tables(spark):
    x = [[1, 2, 3], [1, 2, 3], [4, 6, 3], None, [1, None, 3]]
    out = {r["id"]: r for r in L.landmark_3d(frame(spark, x).selectExpr("*", "7 AS x"), "id").collect()}
    assert out[3]["x"] is None and out[4]["z"] is None
    assert abs(np.hypot(out[0]["x"] - out[2]["x"], out[0]["y"] - out[2]["y"]) - 5) < 1e-6
    assert [out[0][a] for a in "xyz"] == [out[1][a] for a in "xyz"]
    one = L.landmark_3d(frame(spark, [[1, 2, 3]] * 3), "id").collect()
    assert all(r[a] == 0 for r in one for a in "xyz")
    assert L.landmark_3d(frame(spark, [[1, 2]]).limit(0), "id").collect() == []


def test_farthest_points():
    x = np.array([[0.0], [10.0], [4.0], [4.1], [10.0]])
    assert sorted(x[L.farthest_points(x, 3)][:, 0].tolist()) == [0.0, 4.1, 10.0]
    assert len(L.farthest_points(x, 99)) == 4
