"""Report aggregates over labelled or scored rows.

Every report is a small DataFrame; the rows behind it stay on the cluster.
Per-class figures come from one aggregate with a conditional count per class
(partial per task, so one row per task crosses the shuffle); the class
domain is fixed, so zero-count classes are produced without a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import decode_label
from ..schema import CLASSES, UNKNOWN_CLASS


def class_counts(df: DataFrame, class_col: str = "prediction") -> DataFrame:
    """Rows per class, all three classes present (zero when absent), ordered
    Positive, Neutral, Negative. Values outside the classes are left out.

    The class domain is fixed, so this is one global aggregate of three
    conditional counts (partial per task, one row per task to the final
    step), unfolded into the three class rows: no join, no broadcast.
    """
    c = F.col(class_col)
    counts = df.agg(*[F.count_if(c == F.lit(row[0])).alias(f"n_{row[0]}") for row in CLASSES])
    return _class_rows(counts)


def _class_rows(counts: DataFrame) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(row[0]).alias("label"),
                F.lit(row[1]).alias("sentiment"),
                F.lit(row[5]).alias("display_order"),
                F.col(f"n_{row[0]}").alias("n"),
            )
            for row in sorted(CLASSES, key=lambda r: r[5])
        ]
    )
    return counts.select(F.inline(rows))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts per value, most frequent first, nulls left out."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), col)
    )


def confusion_matrix(
    df: DataFrame, label_col: str = "label", prediction_col: str = "prediction"
) -> DataFrame:
    """Always 3 x 3: rows are true classes, columns predicted classes.

    One global aggregate of the nine conditional counts (the class domain is
    fixed), unfolded into three rows; classes absent from the data get a row
    of zeros. No join and no extra job to discover the classes.
    """
    lab, pred = F.col(label_col), F.col(prediction_col)
    return _confusion_rows(df.agg(*_cells(lab, pred)))


def _cells(lab, pred) -> list:
    ids = [row[0] for row in CLASSES]
    return [F.count_if((lab == F.lit(t)) & (pred == F.lit(p))).alias(f"c_{t}_{p}") for t in ids for p in ids]


def _confusion_rows(cells: DataFrame) -> DataFrame:
    names = {row[0]: row[1].lower() for row in CLASSES}
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("true_label"),
                F.lit(row[1]).alias("true_sentiment"),
                *[F.col(f"c_{t}_{p}").alias(f"pred_{names[p]}") for p in names],
            )
            for t, row in ((r[0], r) for r in CLASSES)
        ]
    )
    return cells.select(F.inline(rows))


def summary_counts(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """One row with everything the class reports need, from one pass: ``n``,
    ``hits``, the nine cells, the rows per predicted class, and the rows left
    out of the matrix because a value is none of the classes."""
    lab, pred = F.col(label_col), F.col(prediction_col)
    known = [row[0] for row in CLASSES]
    outside = ~F.coalesce(lab.isin(known) & pred.isin(known), F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(lab.cast("double") == pred.cast("double")).alias("hits"),
        F.count_if(outside).alias("left_out"),
        *[F.count_if(pred == F.lit(c)).alias(f"n_{c}") for c in known],
        *_cells(lab, pred),
    )


def class_reports(counts: DataFrame) -> dict[str, DataFrame]:
    """Distribution, confusion matrix and accuracy from ``summary_counts``."""
    return {
        "sentiment_distribution": _class_rows(counts),
        "confusion_matrix": _confusion_rows(counts),
        "accuracy": counts.select("n", (F.col("hits") / F.nullif("n", F.lit(0))).alias("accuracy"), "left_out"),
    }


def accuracy(df: DataFrame, label_col: str = "label", prediction_col: str = "prediction") -> DataFrame:
    """One row: ``n`` and ``accuracy`` = share of rows with label == prediction."""
    hit = (F.col(label_col).cast("double") == F.col(prediction_col).cast("double")).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def label_audit(df: DataFrame, sentiment_col: str = "Sentiment", label_col: str = "label") -> DataFrame:
    """How raw sentiment strings landed on labels; ``catch_all`` marks rows
    that got class 0 without saying ``negative``."""
    return (
        df.groupBy(sentiment_col, label_col)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn(
            "catch_all",
            (F.col(label_col) == 0)
            & (F.col(sentiment_col).isNull() | (F.col(sentiment_col) != F.lit("negative"))),
        )
    )


def with_class_size(df: DataFrame, class_col: str, out_col: str = "class_size") -> DataFrame:
    """Class size on every row of the class.

    This is a window by meaning (``count(*) over (partition by class)``), but a
    window partitioned by a three-valued column would put a whole class -- a
    third of the data or more -- into one task. The sizes are instead computed
    by a partial aggregate and joined back. ``class_col`` holds class names,
    so the sizes are at most four rows and are broadcast. The input is read
    twice: give a narrow or materialised one.
    """
    names = [row[1] for row in CLASSES] + [UNKNOWN_CLASS[0]]
    sizes = df.where(F.col(class_col).isin(names)).groupBy(class_col).agg(F.count(F.lit(1)).alias(out_col))
    return df.join(F.broadcast(sizes), class_col, "left")


def class_slice(df: DataFrame, class_col: str = "prediction", name: str | None = None) -> DataFrame:
    """Rows with their decoded class and class size; one class if ``name`` given."""
    out = with_class_size(df.withColumn("sentiment", decode_label(F.col(class_col))), "sentiment")
    if name is not None:
        out = out.where(F.col("sentiment") == F.lit(name))
    return out


def report_counts_columns(class_col: str = "sentiment") -> list:
    """Aggregate columns: total and one conditional count per class name."""
    names = [row[1] for row in CLASSES]
    return [F.count(F.lit(1)).alias("total_points")] + [
        F.count_if(F.col(class_col) == F.lit(n)).alias(f"{n.lower()}_count") for n in names
    ]
