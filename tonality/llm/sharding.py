"""Reproducible shuffle into shards by a Feistel permutation, natively.

Rows are numbered 0..N-1 by (bucket, id, size, crc32), where the bucket is a
hash of these three; the number goes through a keyed permutation of 0..N-1,
and the result p gives the shard ``p mod S`` and the slot ``p div S``. Shard
sizes differ by at most one row, slots have no gaps, and whoever knows a row's
number and N can compute its place.

The permutation is a Feistel network on pairs (l, r) with ``l < a``, ``r < b``
and ``a * b >= N``, ``a = ceil(sqrt N)``; a value of N or more walks on along
its cycle until it falls below N, so the result is a bijection of 0..N-1.

Defined results: null texts have no bytes (size 1, crc32 0); null and repeated
ids are numbered like any other; rows equal in id, size and crc32 are counted
before the shuffle (a hot row is one row there) and get consecutive numbers;
an empty table gives no rows; only the three columns named are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, materialise, text_or_empty

ROUNDS = 6
#: Steps along the cycle before an error is raised. Fewer than ``a`` of the
#: ``a * b`` values lie outside 0..N-1, so a step stays outside with a chance
#: below 1 in sqrt(N), and for N < 4096 the walk ends within ``a`` steps anyway.
WALK = 64
ROWS_PER_BUCKET = 4096
#: Buckets summed together first: one task meets a row per 16 million documents.
BUCKETS_PER_BLOCK = 4096
COPIES_PER_CHUNK = 1 << 16
PRIME = 2147483647  # 2**31 - 1


def sides(n: int) -> tuple[int, int]:
    """a, b of the domain: a = ceil(sqrt n), a * b >= n > a * (b - 1)."""
    a = math.isqrt(max(0, n - 1)) + 1
    return a, max(1, -(-n // a))


def _round_value(x: Column, i: Column, seed: int) -> Column:
    """A pseudo-random number below PRIME from x < 2**31, the round and the
    seed, in long arithmetic that can't overflow."""
    key = (F.lit((seed * 1000003 + 12345) % PRIME) + i * F.lit(7919)) % F.lit(PRIME)
    first = (x * F.lit(48271) + key) % F.lit(PRIME)
    return let(first, lambda y: ((y * y + key) % F.lit(PRIME) * F.lit(16807) + x) % F.lit(PRIME))


def feistel(p: Column, n: int, seed: int) -> Column:
    """One pass of p (0..a*b-1) through the network."""
    a, b = (F.lit(x).cast("long") for x in sides(n))

    def turn(v: Column, i: Column) -> Column:
        left = (v["l"] + _round_value(v["r"], i, seed)) % a
        right = (v["r"] + _round_value(v["l"], i, seed)) % b
        even = i % F.lit(2) == 0
        return F.struct(
            F.when(even, left).otherwise(v["l"]).alias("l"), F.when(even, v["r"]).otherwise(right).alias("r")
        )

    start = F.struct(((p - p % b) / b).cast("long").alias("l"), (p % b).alias("r"))
    rounds = F.sequence(F.lit(0).cast("long"), F.lit(ROUNDS - 1).cast("long"))
    return F.aggregate(rounds, start, turn, lambda v: v["l"] * b + v["r"])


def permuted(number: Column, n: int, seed: int) -> Column:
    """The place of a row number in the permutation of 0..n-1."""
    size = F.lit(n).cast("long")
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        feistel(number, n, seed),
        lambda p, _: F.when(p >= size, feistel(p, n, seed)).otherwise(p),
    )
    return let(walk, lambda p: F.when(p < size, p).otherwise(F.raise_error(F.lit("the cycle walk was too short")).cast("long")))


def bases(sizes: DataFrame) -> DataFrame:
    """``_bucket, _base`` of buckets with ``_n`` rows each: the rows in all
    buckets before. Blocks of buckets are summed, the blocks' sums run over all
    blocks, and the buckets' sums inside their block."""
    sizes = sizes.withColumn("_block", F.floor(F.col("_bucket") / BUCKETS_PER_BLOCK))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = sizes.groupBy("_block").agg(F.sum("_n").alias("_n"))
    blocks = blocks.select("_block", before(Window.orderBy("_block")).alias("_start"))
    inside = sizes.withColumn("_inside", before(Window.partitionBy("_block").orderBy("_bucket")))
    return inside.join(blocks, "_block").select("_bucket", (F.col("_start") + F.col("_inside")).alias("_base"))


def numbered(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``rows`` (columns ``keys``) with ``row_number``, 0..n-1 in an order that
    depends on the values only, not on files or partitions."""
    copies = rows.groupBy(*keys).agg(F.count("*").alias("_copies"))
    buckets = max(1, -(-n // ROWS_PER_BUCKET))
    copies = materialise(copies.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("long")), "numbers")
    base = bases(copies.groupBy("_bucket").agg(F.sum("_copies").alias("_n")))
    inside = Window.partitionBy("_bucket").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = copies.withColumn("_before", F.coalesce(F.sum("_copies").over(inside), F.lit(0))).join(base, "_bucket")
    chunk = F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPIES_PER_CHUNK).cast("long"))
    chunks = placed.select(*keys, "_copies", (F.col("_base") + F.col("_before")).alias("_first"), F.explode(chunk).alias("_at"))
    last = F.least(F.col("_at") + F.lit(COPIES_PER_CHUNK - 1), F.col("_copies") - 1)
    return chunks.select(*keys, "_first", F.explode(F.sequence("_at", last)).alias("_i")).select(
        *keys, (F.col("_first") + F.col("_i")).alias("row_number")
    )


def shard(docs: DataFrame, shards: int = 16, seed: int = 42, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, row_number, shard, slot`` of each row."""
    t = text_or_empty(text)
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(F.encode(t, "UTF-8")).alias("text_crc32"),
    )
    n = docs.count()
    placed = numbered(rows, ["doc_id", "size", "text_crc32"], n).withColumn("_place", permuted(F.col("row_number"), n, seed))
    # a generator in between keeps the walk from being computed for each of its uses
    place = F.explode(F.array(F.col("_place"))).alias("_p")
    return placed.select("doc_id", "size", "text_crc32", "row_number", place).select(
        F.col("doc_id").alias(key),
        "size",
        "text_crc32",
        "row_number",
        (F.col("_p") % shards).cast("int").alias("shard"),
        ((F.col("_p") - F.col("_p") % shards) / shards).cast("long").alias("slot"),
    )
