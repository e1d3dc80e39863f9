"""Top-k selection that no single task has to merge.

``orderBy(...).limit(k)`` sends the k best rows of every partition to one task:
k x partitions rows, which grows with the cluster. Here histograms find where
the k-th row lies: an aggregate counts the rows per range of the key (at most
``BINS`` rows reach the driver), the range that holds the k-th row is cut into
``BINS`` again, and so on until it holds few rows or one value. Rows before the
range are in by a filter; only the rows of the last range are sorted. Ties in
the count go on with the tie column, six bytes at a time, in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 1024
SMALL = 50_000  # a last range of so many rows is sorted as it is
_BYTES = 6


@dataclass
class Edge:
    """Where the k-th smallest key lies: in [low, high], which holds ``n`` rows;
    ``need`` of them are among the k."""

    low: int
    high: int
    n: int
    need: int


def find_edge(rows: DataFrame, key: Column, k: int, small: int) -> Edge | None:
    """The range of the k-th smallest ``key`` (long, not null), narrowed until it
    holds at most ``small`` rows or one value. None if there are at most k rows."""
    ends = rows.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n")).first()
    if ends["n"] <= k:
        return None
    at = Edge(ends["low"], ends["high"], ends["n"], k)
    while at.low < at.high and at.n > small:
        width = (at.high - at.low) // BINS + 1
        inside = rows.where(key.between(F.lit(at.low), F.lit(at.high)))
        place = F.expr(f"div(k - {at.low}, {width})")
        sizes = inside.select(key.alias("k")).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()
        for row in sorted(sizes, key=lambda r: r["bin"]):
            if row["n"] >= at.need:
                low = at.low + row["bin"] * width
                at = Edge(low, min(at.high, low + width - 1), row["n"], at.need)
                break
            at.need -= row["n"]
    return at


def _chunk(tie: str, number: int) -> Column:
    """Six bytes of a string as a number; their order is that of the strings."""
    part = F.substring(F.encode(F.col(tie), "UTF-8"), 1 + _BYTES * number, _BYTES)
    return F.conv(F.rpad(F.hex(part), 2 * _BYTES, "0"), 16, 10).cast("long")


def top_rows(rows: DataFrame, k: int, count: str, tie: str, small: int = SMALL) -> DataFrame:
    """The first k rows by ``count`` downwards, then ``tie`` (a string) upwards,
    in no order. ``rows`` is read several times: give a materialised table.
    Defined results: rows without a count come last; a null tie counts as the
    empty string, which it sorts before; k <= 0 gives no rows."""
    if k <= 0:
        return rows.limit(0)
    taken = F.lit(False)  # rows before the edge
    edge = F.lit(True)
    key: Column = -F.coalesce(F.col(count).cast("long"), F.lit(-(1 << 62)).cast("long"))
    need, number = k, 0
    while True:
        at = find_edge(rows.where(edge), key, need, small)
        if at is None:
            return rows.where(taken | edge)
        taken = taken | (edge & (key < F.lit(at.low)))
        edge = edge & key.between(F.lit(at.low), F.lit(at.high))
        need = at.need
        if at.n <= max(small, need):
            break
        longest = rows.where(edge).agg(F.max(F.octet_length(tie))).first()[0] or 0
        if number * _BYTES >= longest:  # only equal strings are left
            break
        key = F.coalesce(_chunk(tie, number), F.lit(-1).cast("long"))
        number += 1
    last = rows.where(edge).orderBy(F.col(count).desc_nulls_last(), F.col(tie).asc_nulls_first()).limit(need)
    return rows.where(taken).unionByName(last)


def most_frequent(rows: DataFrame, count: str, most: int) -> DataFrame:
    """All rows whose count is above a threshold, the lowest that leaves at most
    ``most`` rows (ties at the threshold stay out together)."""
    key = -F.col(count).cast("long")
    at = find_edge(rows, key, most, 0)
    return rows if at is None else rows.where(key < F.lit(at.low)) if at.need < at.n else rows.where(key <= F.lit(at.low))
