import math
import zlib
from collections import Counter

from pyspark.sql import functions as F
from tonality.llm import sharding as S

from .helpers import docs_of, edge_docs, empty_docs


def feistel(p, n, seed):
    a, b = S.sides(n)
    left, right = p // b, p % b

    def value(x, i):
        k = ((seed * 1000003 + 12345) % S.PRIME + i * 7919) % S.PRIME
        y = (x * 48271 + k) % S.PRIME
        return ((y * y + k) % S.PRIME * 16807 + x) % S.PRIME

    for i in range(S.ROUNDS):
        if i % 2 == 0:
            left = (left + value(right, i)) % a
        else:
            right = (right + value(left, i)) % b
    return left * b + right


def permuted(p, n, seed):
    p = feistel(p, n, seed)
    while p >= n:
        p = feistel(p, n, seed)
    return p


def test_permutation_equals_brute_force_and_is_a_bijection(spark):
    for n in (1, 2, 3, 5, 17, 100, 1000):
        got = [r.p for r in spark.range(n).select("id", S.permuted(F.col("id"), n, 7).alias("p")).orderBy("id").collect()]
        assert got == [permuted(i, n, 7) for i in range(n)]
        assert sorted(got) == list(range(n))


def test_large_domain_does_not_overflow(spark):
    n = 10**12 + 39
    some = [0, 1, n // 2, n - 1]
    df = spark.createDataFrame([(x,) for x in some], "id long").select("id", S.permuted(F.col("id"), n, 3).alias("p"))
    assert {r.id: r.p for r in df.collect()} == {x: permuted(x, n, 3) for x in some}
    a, b = S.sides(n)
    assert a * b >= n and a == math.isqrt(n - 1) + 1


def check(rows, shards):
    by = Counter(r.shard for r in rows)
    assert len(rows) < shards or max(by.values()) - min(by.get(s, 0) for s in range(shards)) <= 1
    for s in by:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(by[s]))


def test_shards_are_even_and_reproducible(spark, monkeypatch):
    monkeypatch.setattr(S, "ROWS_PER_BUCKET", 7)
    docs = docs_of(spark, [(i, "x" * (i % 50)) for i in range(500)])
    first = S.shard(docs, 16).collect()
    check(first, 16)
    again = S.shard(docs.repartition(5), 16).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in first} == {(r.doc_id, r.shard, r.slot) for r in again}
    numbers = {r.row_number: r for r in first}
    assert sorted(numbers) == list(range(500))
    for k, r in numbers.items():
        p = permuted(k, 500, 42)
        assert (r.shard, r.slot) == (p % 16, p // 16)


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(S, "COPIES_PER_CHUNK", 3)
    docs = edge_docs(spark).unionByName(docs_of(spark, [(99, "same")] * 20).select(
        "doc_id", "text", *[F.lit(None).cast(t).alias(n) for n, t in edge_docs(spark).dtypes[2:]]))
    rows = S.shard(docs, 4).collect()
    check(rows, 4)
    expected = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
    assert S.shard(empty_docs(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = S.shard(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_bases_sum_over_blocks_of_buckets(spark, monkeypatch):
    monkeypatch.setattr(S, "BUCKETS_PER_BLOCK", 3)
    sizes = [(b, (b * 7) % 5 + 1) for b in range(20) if b not in (4, 9, 10, 11)]
    got = {r["_bucket"]: r["_base"] for r in S.bases(spark.createDataFrame(sizes, "_bucket long, _n long")).collect()}
    assert got == {b: sum(n for c, n in sizes if c < b) for b, _ in sizes}
