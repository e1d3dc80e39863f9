import random

from tonality.llm.components import components


def brute(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    return {x: find(x) for x in parent}


def run(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    rows = components(df).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


def test_components_equal_union_find(spark):
    r = random.Random(0)
    path = [(i, i + 1) for i in range(60)]
    r.shuffle(path)
    star = [(1000, 1001 + i) for i in range(50)] + [(999, 1020)]
    some = [(r.randint(2000, 2200), r.randint(2000, 2200)) for _ in range(120)]
    pairs = path + star + some + [(5, 5), (None, 3), (7, None), (60, 59)]
    assert run(spark, pairs) == brute(pairs)
    assert run(spark, []) == {}
