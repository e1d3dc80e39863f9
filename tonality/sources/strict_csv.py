"""RFC-4180 CSV files of any size, read in splits.

A quoted field may hold line breaks, so where a record starts depends on all
quotes before it, and Spark's multi-line reader takes a whole file in one task.
Here files are read as lines, in Spark's own splits:

1. Each split is read twice in thought: once as if it began outside quotes, once
   inside. A line without quotes changes nothing; another line maps the state
   at its start to that at its end. A split's summary is two bits.
2. The summaries of a file are composed in order of their offsets (a window
   over one small row per split), which tells how each split really begins. The
   splits that begin inside quotes are sent to the tasks: at most a file hash
   and an offset per split.
3. Each split now puts its lines together to records. At most two pieces of a
   split belong to records that cross its border; they are joined from a second
   reading that keeps only those pieces.
4. Records are parsed with ``from_csv``, by the same parser and options as the
   multi-line reader's.

The text is never shuffled: only summaries and pieces at borders are.

Defined results: records end at a line feed, with or without a carriage return
before it; if a file's first line ends with both, both are one line feed within
its fields too; empty lines between records are no records; the first record of a
file is its header; a file that ends inside quotes ends its last record; an
empty file has no records.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The task-side functions travel with the tasks: workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The options of the strict reader, shared by both ways of reading.
STRICT_OPTIONS = {"multiLine": "true", "escape": '"', "mode": "PERMISSIVE"}


def _close(line: str, at: int) -> int:
    """Index after the quote that closes a quoted field, or -1."""
    while True:
        at = line.find('"', at)
        if at < 0 or not line.startswith('""', at):
            return at + 1 if at >= 0 else -1
        at += 2


def inside_after(line: str, inside: bool) -> bool:
    """Is the end of a line within quotes, if its start is (not)?"""
    at = 0
    while True:
        if inside or line.startswith('"', at):
            at = _close(line, at if inside else at + 1)
            if at < 0:
                return True
            inside = False
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the split they start in; the order within a split is that of
    the file, as no exchange follows."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[str], list[bool]]]:
    """(file, block, lines, which have quotes) of parts of splits, in order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        value = batch.column("value")
        quoted = pc.match_substring(value, '"').to_pylist()
        lines = value.to_pylist()
        start = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or file[i] != file[start] or block[i] != block[start]:
                yield file[start], block[start], lines[start:i], quoted[start:i]
                start = i


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out = None, []
    for file, block, lines, quoted in _runs(batches):
        if now is None or now[:2] != [file, block]:
            now = [file, block, False, True, block == 0 and lines[0].endswith("\r")]
            out.append(now)
        for line, has in zip(lines, quoted, strict=True):
            if has:
                now[2], now[3] = inside_after(line, now[2]), inside_after(line, now[3])
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["file", "block", "from_out", "from_in", "returns"])


SUMMARY = "file long, block long, from_out boolean, from_in boolean, returns boolean"


def split_starts(summaries: DataFrame) -> DataFrame:
    """``file, block, inside, returns``: whether each split begins within quotes,
    and whether the file's first line ends with a carriage return. The last split whose end doesn't depend on its start settles the state; every
    split since then that swaps it turns it over."""
    order = Window.partitionBy("file").orderBy("block")
    swaps = F.col("from_out").cast("int") * (1 - F.col("from_in").cast("int"))
    counted = summaries.withColumn("swaps", F.sum(swaps).over(order))
    settled = F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").cast("int").alias("state"), "swaps"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    known = F.last(settled, ignorenulls=True).over(before)
    turned = F.coalesce(F.last("swaps").over(before), F.lit(0)) - F.coalesce(known["swaps"], F.lit(0))
    inside = (F.coalesce(known["state"], F.lit(0)) + turned) % 2 == 1
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counted.select("file", "block", inside.alias("inside"), F.max("returns").over(whole).alias("returns"))


RECORD = "file long, block long, piece int, first boolean, record string"
WHOLE, HEAD, MIDDLE, TAIL = range(4)


def _records(starts, pieces: bool):
    """The whole records of the splits, or the pieces at their borders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = starts.value
        now, held, inside, returns, fresh, begun = None, [], False, False, False, False

        def row(piece: int, lines: list[str]) -> tuple:
            text = "\n".join(lines)
            if returns or piece in (WHOLE, HEAD):  # before a line break, or at the record's end
                text = text.removesuffix("\r")
            return (*now, piece, fresh, text.replace("\r\n", "\n") if returns else text)

        def last() -> list[tuple]:
            """What the split leaves open: it goes on in the next, or the file ends."""
            if not held:
                return []
            return [row(TAIL if begun else MIDDLE, held)]

        for file, block, lines, quoted in _runs(batches):
            out = []
            if now != (file, block):
                out += last() if now is not None else []
                if (file, block) not in known:
                    raise RuntimeError("the splits of the file changed between its readings; keep the read settings until the result is used")
                now, held = (file, block), []
                inside, returns = known[file, block]
                begun = not inside  # did the open record begin in this split?
                fresh = block == 0  # is the next record the file's first?
            for line, has in zip(lines, quoted, strict=True):
                held.append(line)
                if has:
                    inside = inside_after(line, inside)
                if not inside:
                    if begun and held not in ([""], ["\r"]):
                        out.append(row(WHOLE, held))
                        fresh = False
                    elif not begun:
                        out.append(row(HEAD, held))
                    held, begun = [], True
            if out := [r for r in out if (r[2] != WHOLE) == pieces and (pieces or not r[3])]:
                yield _batch(out)
        if now is not None and pieces and (rest := last()):
            yield _batch(rest)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["file", "block", "piece", "first", "record"])


def _crossing(pieces: DataFrame) -> DataFrame:
    """The records that cross borders: a TAIL, any MIDDLEs, a HEAD."""
    order = Window.partitionBy("file").orderBy("block", F.col("piece") == TAIL)
    number = F.sum((F.col("piece") == TAIL).cast("long")).over(order)
    parts = pieces.withColumn("number", number)
    joined = F.array_sort(F.collect_list(F.struct("block", (F.col("piece") == TAIL).alias("later"), "record")))
    text = F.array_join(F.transform(joined, lambda p: p["record"]), "\n")  # one record's pieces
    found = parts.groupBy("file", "number").agg(text.alias("record"), F.max("first").alias("first"))
    return found.where("NOT first").select("record")


def read_strict_splits(spark: SparkSession, path: str, schema: StructType, corrupt_column: str) -> DataFrame:
    """Records of the CSV files under ``path``, with the columns of ``schema``
    (records that don't parse: as they are in ``corrupt_column``). The splits of
    the files are those of the session's settings, which must stay as they are
    until the result has been used."""
    lines = _lines(spark, path)
    summaries = lines.mapInArrow(_summaries, SUMMARY)
    # one small row for each split, that is for maxPartitionBytes of input
    found = split_starts(summaries).toArrow().to_pylist()
    starts = spark.sparkContext.broadcast({(r["file"], r["block"]): (r["inside"], r["returns"]) for r in found})
    whole = lines.mapInArrow(_records(starts, False), RECORD).select("record")
    crossing = _crossing(lines.mapInArrow(_records(starts, True), RECORD))
    options = STRICT_OPTIONS | {"columnNameOfCorruptRecord": corrupt_column}
    parsed = whole.unionByName(crossing).select(F.from_csv("record", schema.simpleString()[len("struct<") : -1].replace(":", " "), options).alias("r"))
    return parsed.select("r.*")
