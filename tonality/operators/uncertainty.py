"""Uncertainty of accuracies: a Poisson bootstrap and a paired test of two models.

Each replicate gives every scored row a weight drawn from Poisson(1), which is
the bootstrap for many rows without drawing rows: the weight is a function of
(seed, replicate, row id) alone, so that all replicates are conditional sums of
one aggregate. One md5 of the row id serves eight replicates (four hex digits
each). A task sends one row of a few sums a replicate to the final step,
whatever the number of rows; nothing else is shuffled.

Defined results: a prediction that is null (or a null label) is a miss; rows
with one id share their weights (the id should tell rows apart), a null id
counting as the id "null"; a replicate without any weight is left out of the
interval; without rows the accuracies and bounds are null and the p-value is 1.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = 1 << 16
PER_HASH = 8


def poisson_thresholds(levels: int = LEVELS) -> list[int]:
    """The k-th number is the first of ``levels`` equal steps at which a
    Poisson(1) variable exceeds k; the list ends where none does."""
    found, below, k = [], 0.0, 0
    while True:
        below += math.exp(-1) / math.factorial(k)
        at = round(below * levels)
        if at >= levels:
            return found
        found.append(at)
        k += 1


def weights(id_col: Column, replicates: int, seed: int) -> Column:
    """A row's Poisson(1) weights in replicates 0, 1, .. as an array."""
    ident = F.coalesce(id_col.cast("string"), F.lit("null"))
    digests = F.array(*[F.md5(F.concat(F.lit(f"{seed}:{i}:"), ident)) for i in range(-(-replicates // PER_HASH))])
    limits = F.array(*[F.lit(t) for t in poisson_thresholds()])
    step = lambda d, i: F.conv(F.substring(d, 4 * i + 1, 4), 16, 10).cast("int")
    drawn = lambda x: F.size(F.filter(limits, lambda t: t <= x))
    each = F.transform(digests, lambda d: F.transform(F.array(*[step(d, i) for i in range(PER_HASH)]), drawn))
    return F.slice(F.flatten(each), 1, replicates)


def hit(label: Column, prediction: Column) -> Column:
    return F.coalesce((label.cast("double") == prediction.cast("double")).cast("int"), F.lit(0))


def _sums(df: DataFrame, id_col: str, hits: dict[str, Column], replicates: int, seed: int) -> DataFrame:
    """One row: ``rows_<r>`` and ``<model>_<r>`` for each replicate r, and for
    r = ``replicates`` the plain counts (every weight 1)."""
    drawn = F.concat(weights(F.col(id_col), replicates, seed), F.array(F.lit(1)))
    rows = df.select(drawn.alias("w"), *[h.cast("int").alias(f"hit_{m}") for m, h in hits.items()])
    marks = {"rows": F.lit(1)} | {m: F.col(f"hit_{m}") for m in hits}
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return rows.agg(*[total(F.col("w")[r] * c).alias(f"{m}_{r}") for m, c in marks.items() for r in range(replicates + 1)])


def bootstrap(df: DataFrame, id_col: str, hits: dict[str, Column], replicates: int = 64, seed: int = 42) -> DataFrame:
    """``replicate, rows, <model>..``: the weight of all rows and, for each of
    ``hits`` (columns of 0 and 1 by model; no model is called "rows"), the
    weight of the rows it marks."""
    sums = _sums(df, id_col, hits, replicates, seed)
    each = [F.struct(F.lit(r).alias("replicate"), *[F.col(f"{m}_{r}").alias(m) for m in ("rows", *hits)]) for r in range(replicates)]
    return sums.select(F.inline(F.array(*each)))


def accuracy_interval(
    df: DataFrame, id_col: str, hits: dict[str, Column], level: float = 0.9, replicates: int = 64, seed: int = 42
) -> DataFrame:
    """``model, n, accuracy, low, high``: accuracy over all rows and the bounds
    of its bootstrap interval (order statistics of the replicates)."""
    sums = _sums(df, id_col, hits, replicates, seed)
    share = lambda m, r: F.col(f"{m}_{r}") / F.nullif(F.col(f"rows_{r}"), F.lit(0))
    sorted_ = {m: F.sort_array(F.array_compact(F.array(*[share(m, r) for r in range(replicates)]))) for m in hits}
    listed = sums.select("*", *[c.alias(f"list_{m}") for m, c in sorted_.items()])
    place = lambda c, p: F.get(c, F.floor((F.size(c) - 1) * p + 0.5).cast("int"))
    tail = (1 - level) / 2
    rows = [
        F.struct(
            F.lit(m).alias("model"),
            F.col(f"rows_{replicates}").alias("n"),
            share(m, replicates).alias("accuracy"),
            place(F.col(f"list_{m}"), tail).alias("low"),
            place(F.col(f"list_{m}"), 1 - tail).alias("high"),
        )
        for m in hits
    ]
    return listed.select(F.inline(F.array(*rows)))


def paired_test(df: DataFrame, first: Column, second: Column) -> DataFrame:
    """McNemar's test of two models on the same rows: ``only_first`` and
    ``only_second`` rows that one alone gets right, the chi-squared statistic
    with continuity correction, and its p-value (one degree of freedom)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((first == 1) & (second == 0)).alias("only_first"),
        F.count_if((first == 0) & (second == 1)).alias("only_second"),
    )
    b, c = F.col("only_first"), F.col("only_second")
    beyond = F.greatest(F.abs(b - c) - 1, F.lit(0)).cast("double")
    counts = counts.withColumn("statistic", F.when(b + c > 0, beyond * beyond / (b + c)).otherwise(0.0))
    return counts.withColumn("p_value", chi_squared_tail(F.col("statistic")))


def chi_squared_tail(x: Column) -> Column:
    """P(chi-squared with one degree > x) = erfc(sqrt(x / 2)), by the rational
    approximation of the error function with five terms (error below 1.5e-7)."""
    # fixed values: coefficients of the published approximation
    p, coefficients = 0.3275911, (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    z = F.sqrt(x / 2)
    t = 1 / (1 + p * z)
    poly = F.lit(0.0)
    for a in reversed(coefficients):
        poly = t * (F.lit(a) + poly)
    return F.when(x == 0, 1.0).otherwise(poly * F.exp(-z * z))
