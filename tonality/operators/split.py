"""Reproducible splitting and exact-size sampling keyed on a row id.

``randomSplit`` and ``sample`` depend on how rows fall into partitions, so
they change with the cluster and the file layout. Here the decision for a
row is a function of (seed, id) alone: an md5 bucket. No shuffle is needed
for the split; the sample is a top-k on the hash after a threshold filter
that lets only about ``k`` rows through, so the final merge stays small
however many partitions the input has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN, TEST = "train", "test"


def hash_key(id_col: Column, seed: int) -> Column:
    """Hex md5 of ``"<seed>:<id>"``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_col.cast("string")))


def bucket(id_col: Column, seed: int = 42, buckets: int = 100) -> Column:
    """Bucket 0..buckets-1 from the first 8 hex digits of the hash."""
    first8 = F.conv(F.substring(hash_key(id_col, seed), 1, 8), 16, 10).cast("long")
    return (first8 % F.lit(buckets)).cast("int")


def split_column(id_col: Column, train_pct: int = 80, seed: int = 42) -> Column:
    return F.when(bucket(id_col, seed) < F.lit(train_pct), F.lit(TRAIN)).otherwise(F.lit(TEST))


def with_split(df: DataFrame, id_col: str, train_pct: int = 80, seed: int = 42) -> DataFrame:
    return df.withColumn("split", split_column(F.col(id_col), train_pct, seed))


def train_test_split(df: DataFrame, id_col: str, train_pct: int = 80, seed: int = 42, method: str = "hash"):
    """(train, test): disjoint and together the whole input.

    ``method="hash"`` (default) keys the decision on (seed, id), so it is
    stable under any repartitioning. ``method="random"`` is Spark's
    ``randomSplit``, as the original pipeline used; its result depends on the
    partitioning of ``df``.
    """
    if method == "random":
        train, test = df.randomSplit([train_pct / 100.0, 1 - train_pct / 100.0], seed=seed)
        return train, test
    if method != "hash":
        raise ValueError(f"method must be 'hash' or 'random', got {method!r}")
    b = bucket(F.col(id_col), seed)
    return df.where(b < F.lit(train_pct)), df.where(b >= F.lit(train_pct))


def exact_sample(df: DataFrame, id_col: str, n: int = 3000, seed: int = 42, margin: float = 1.5) -> DataFrame:
    """Exactly ``min(N, n)`` rows without replacement, the same on any layout:
    the ``n`` rows with the smallest hash of (seed, id), ties broken by id.
    ``id_col`` must tell rows apart: rows that share an id share its hash and
    come in or stay out together.

    A plain ``orderBy(hash).limit(n)`` sends ``n`` rows from *every* partition
    to one task, which grows with the partition count. The hash prefix is
    uniform, so rows are first kept only below a threshold expected to pass
    about ``margin * n`` rows; if fewer than ``n`` pass (rare), the threshold
    is raised. Only the survivors reach the final top-k, so the result is
    still exactly the global top-k. Costs one count of the input (parquet
    answers it from footers) and one count of the survivors.
    """
    keyed = df.withColumn("_sample_key", hash_key(F.col(id_col), seed))
    total = df.count()
    if total > n:
        prefix = F.conv(F.substring(F.col("_sample_key"), 1, 8), 16, 10).cast("long")
        space = 1 << 32
        frac = min(1.0, margin * n / total)
        while frac < 1.0:
            candidate = keyed.where(prefix < F.lit(int(frac * space)))
            if candidate.count() >= n:
                keyed = candidate
                break
            frac = min(1.0, frac * 2)
    return keyed.orderBy("_sample_key", id_col).limit(n).drop("_sample_key")


# ---- SQL text (DuckDB dialect) ------------------------------------------------


def sql_hash_key(id_expr: str, seed: int) -> str:
    return f"md5('{seed}:' || CAST({id_expr} AS VARCHAR))"


def sql_bucket(id_expr: str, seed: int = 42, buckets: int = 100) -> str:
    return f"CAST(CAST(('0x' || substr({sql_hash_key(id_expr, seed)}, 1, 8)) AS BIGINT) % {buckets} AS INTEGER)"


def sql_split(id_expr: str, train_pct: int = 80, seed: int = 42) -> str:
    return f"CASE WHEN {sql_bucket(id_expr, seed)} < {train_pct} THEN '{TRAIN}' ELSE '{TEST}' END"
