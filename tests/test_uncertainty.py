"""Poisson bootstrap and paired test against plain Python."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tonality.operators import uncertainty as U


def plain_weight(ident, replicate, seed):
    digest = hashlib.md5(f"{seed}:{replicate // 8}:{ident}".encode()).hexdigest()
    share = int(digest[4 * (replicate % 8) :][:4], 16) / 65536
    k, below = 0, math.exp(-1)
    while share >= round(below * 65536) / 65536 and round(below * 65536) < 65536:
        k += 1
        below += math.exp(-1) / math.factorial(k)
    return k


def scored(spark, rows):
    return spark.createDataFrame(rows, "id long, label int, prediction double, w string, rows_0 int")


def hits():
    return {"a": U.hit(F.col("label"), F.col("prediction")), "b": U.hit(F.col("label"), F.lit(1))}


@pytest.fixture(scope="module")
def rows():
    some = [(i, i % 3, float(i % 3 if i % 5 else 0), "x", 1) for i in range(300)]
    return some + [(None, 1, 1.0, "x", 1), (900, None, 1.0, None, 1), (901, 1, None, "x", 1), (7, 1, 1.0, "x", 1)]


def marks(r):
    a = int(r[1] is not None and r[2] is not None and float(r[1]) == r[2])
    return a, int(r[1] == 1)


def test_replicates_equal_plain_sums(spark, rows):
    got = U.bootstrap(scored(spark, rows), "id", hits(), replicates=11, seed=3).orderBy("replicate").collect()
    assert [r.replicate for r in got] == list(range(11))
    for r in got:
        w = [plain_weight("null" if x[0] is None else x[0], r.replicate, 3) for x in rows]
        assert r.rows == sum(w)
        assert (r.a, r.b) == tuple(sum(v * marks(x)[i] for v, x in zip(w, rows, strict=True)) for i in (0, 1))


def test_weights_are_poisson(spark):
    sums = U.bootstrap(spark.range(20000).withColumn("one", F.lit(1)), "id", {"one": F.col("one")}, replicates=8).collect()
    for r in sums:  # mean 1, variance 1
        assert abs(r.rows - 20000) < 5 * math.sqrt(20000) and r.one == r.rows


def test_interval_holds_the_accuracy_and_any_layout_gives_it(spark, rows):
    df = scored(spark, rows)
    got = {r.model: r for r in U.accuracy_interval(df, "id", hits()).collect()}
    again = {r.model: r for r in U.accuracy_interval(df.repartition(7), "id", hits()).collect()}
    assert got == again
    for i, m in enumerate("ab"):
        p = sum(marks(x)[i] for x in rows) / len(rows)
        assert got[m].n == len(rows) and abs(got[m].accuracy - p) < 1e-12
        assert got[m].low < p < got[m].high
        assert abs((got[m].high - got[m].low) / (3.29 * math.sqrt(p * (1 - p) / len(rows))) - 1) < 0.5


def test_paired_test(spark, rows):
    h = hits()
    r = U.paired_test(scored(spark, rows), h["a"], h["b"]).first()
    b = sum(marks(x) == (1, 0) for x in rows)
    c = sum(marks(x) == (0, 1) for x in rows)
    statistic = max(abs(b - c) - 1, 0) ** 2 / (b + c)
    assert (r.n, r.only_first, r.only_second) == (len(rows), b, c)
    assert abs(r.statistic - statistic) < 1e-9 and abs(r.p_value - math.erfc(math.sqrt(statistic / 2))) < 1e-6


def test_empty_table(spark):
    df = scored(spark, [])
    assert [(r.n, r.accuracy, r.low, r.high) for r in U.accuracy_interval(df, "id", hits()).collect()] == [(0, None, None, None)] * 2
    r = U.paired_test(df, *hits().values()).first()
    assert (r.n, r.statistic, r.p_value) == (0, 0.0, 1.0)
    assert {(x.rows, x.a) for x in U.bootstrap(df, "id", hits()).collect()} == {(0, 0)}
