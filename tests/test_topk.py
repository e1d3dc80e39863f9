"""Top-k by histograms against a sort."""

import random

import pytest

from tonality.operators.topk import most_frequent, top_rows

WORDS = ["", "a", "aa", "gemeinsam-anfang-x", "gemeinsam-anfang-y", "gemeinsam-anfang", "é", "z", "你好", "😀", "zz" * 40]


def table(spark, seed, n, most):
    r = random.Random(seed)
    words = sorted({r.choice(WORDS) + (str(r.randrange(10**6)) if r.random() < 0.8 else "") for _ in range(n)})
    rows = [(w, r.choice([1, 1, 1, 2, r.randint(1, most)])) for w in words]
    return rows, spark.createDataFrame(rows, "term string, n long").repartition(7)


@pytest.mark.parametrize("small", [1, 10, 10_000])
@pytest.mark.parametrize("most", [3, 10**12])
def test_top_rows_equal_a_sort(spark, small, most):
    rows, df = table(spark, most, 600, most)
    df = df.cache()
    ranked = sorted(rows, key=lambda r: (-r[1], r[0].encode()))
    for k in (0, 1, 7, 300, len(rows) - 1, len(rows), 10**6):
        assert sorted(map(tuple, top_rows(df, k, "n", "term", small).collect())) == sorted(ranked[:k])


def test_no_sort_sees_more_than_the_last_range(spark):
    """The plan's only sort is of the range that holds the k-th row."""
    _, df = table(spark, 5, 400, 50)
    plan = top_rows(df, 100, "n", "term", 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("GlobalLimit") == 1 and "Union" in plan


def test_nulls_repeats_and_an_empty_table(spark):
    rows = [("b", 2), ("b", 2), (None, 2), ("c", None), (None, None)]
    df = spark.createDataFrame(rows, "term string, n long")
    assert sorted(map(str, map(tuple, top_rows(df, 3, "n", "term", 1).collect()))) == sorted(map(str, [("b", 2), ("b", 2), (None, 2)]))
    assert top_rows(df, 1, "n", "term", 1).first()["term"] is None
    assert top_rows(df.limit(0), 3, "n", "term").collect() == []


def test_most_frequent_is_a_threshold(spark):
    rows, df = table(spark, 9, 300, 40)
    for most in (0, 1, 17, 120, 10**6):
        got = sorted(r["n"] for r in most_frequent(df, "n", most).collect())
        counts = sorted((n for _, n in rows), reverse=True)
        edge = counts[most] if most < len(counts) else 0
        assert got == sorted(n for n in counts if n > edge)
