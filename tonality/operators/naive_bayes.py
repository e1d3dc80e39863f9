"""Multinomial Naive Bayes over TF-IDF, written as joins and aggregates.

Model (smoothing λ, N training documents, C classes present, V vocabulary
terms, v = tf * idf, s_cw = sum of v of term w over class c, s_c = sum over w):

    prior_c = ln(n_c + λ) - ln(N + C λ)
    θ_cw    = ln(s_cw + λ) - ln(s_c + V λ)
    score_c = prior_c + Σ_w v_w θ_cw          prediction = argmax, ties -> lower c

This is what ``Tokenizer -> CountVectorizer -> IDF -> NaiveBayes`` computes;
the relational form lets the same numbers be checked with SQL.

Plan shape: the classes are those of the training rows (one small aggregate).
Then one ``groupBy(term)`` gives the count, the document frequency and the
term's sum in every class; as idf is the same for all rows of a term, s_cw is
idf times that sum, so no second pass and no join is needed. The model (V rows
with one θ per class) is materialised in the shared folder. Scoring is one join
of per-row term counts with it (broadcast if its measured size allows) and one
aggregation per document (C doubles per document cross the shuffle).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ml_tokens
from ..sources.sinks import cut_lineage
from .features import DEFAULT_VOCAB_SIZE, measured_broadcast, term_counts
from .topk import top_rows


@dataclass
class NaiveBayesTables:
    terms: DataFrame  # term, rank, df, idf, theta (array: one per class)
    priors: list[float]
    classes: list[int]  # ascending
    smoothing: float


def _doc_terms(df: DataFrame, id_col: str | None, text_col: str, keep: list[str], outer: bool = False) -> DataFrame:
    gen = F.inline_outer if outer else F.inline
    columns = [F.col(c) for c in ([id_col] if id_col else []) + keep]
    return df.select(*columns, gen(term_counts(ml_tokens(F.col(text_col)))))


def class_totals(train: DataFrame, label_col: str) -> dict[int, int]:
    """Training rows per class. Labels must be whole, non-negative numbers."""
    label = F.col(label_col)
    usable = F.coalesce((label >= 0) & (label == F.floor(label)), F.lit(False))
    rows = train.groupBy(label.alias("label"), usable.alias("ok")).agg(F.count(F.lit(1)).alias("n")).limit(1001).collect()
    bad = [r["label"] for r in rows if not r["ok"]]
    if bad or len(rows) > 1000:
        raise ValueError(f"class labels must be at most 1000 whole numbers from 0 on; found {bad[:5] or 'more'}")
    return {int(r["label"]): r["n"] for r in sorted(rows, key=lambda r: r["label"])}


def fit(
    train: DataFrame,
    id_col: str,
    text_col: str = "processed_comment",
    label_col: str = "label",
    vocab_size: int = DEFAULT_VOCAB_SIZE,
    smoothing: float = 1.0,
) -> NaiveBayesTables:
    """The model of the training rows; ``id_col`` is not read (each row is a
    document)."""
    totals = class_totals(train, label_col)
    classes = list(totals)
    tf = _doc_terms(train, None, text_col, [label_col])
    stats = tf.groupBy("term").agg(
        F.sum("tf").cast("long").alias("n"),
        F.count(F.lit(1)).alias("df"),
        *[F.sum(F.when(F.col(label_col) == c, F.col("tf")).otherwise(F.lit(0))).alias(f"tf_{c}") for c in classes],
    )
    return model_of(stats, totals, vocab_size, smoothing)


def model_of(stats: DataFrame, totals: dict[int, int], vocab_size: int = DEFAULT_VOCAB_SIZE, smoothing: float = 1.0) -> NaiveBayesTables:
    """The model of term statistics ``term, n, df, tf_<class>..`` and of the
    documents per class."""
    import math

    if not totals:
        raise ValueError("no training rows")
    lam = float(smoothing)
    classes, n_total = list(totals), sum(totals.values())
    spark = stats.sparkSession
    top = cut_lineage(spark, top_rows(cut_lineage(spark, stats, "nb-stats"), vocab_size, "n", "term"), "nb-terms")
    idf = F.log((F.lit(float(n_total)) + 1.0) / (F.col("df").cast("double") + 1.0))
    sums = top.select("term", "n", "df", idf.alias("idf"), *[(idf * F.col(f"tf_{c}")).alias(f"s_{c}") for c in classes])
    total = sums.agg(F.count(F.lit(1)).alias("v"), *[F.coalesce(F.sum(f"s_{c}"), F.lit(0.0)).alias(f"s_{c}") for c in classes]).first()
    priors = [math.log(totals[c] + lam) - math.log(n_total + len(classes) * lam) for c in classes]
    # with no smoothing and nothing seen the logarithm is that of 0
    log = lambda x: F.when(x > 0, F.log(x)).otherwise(F.lit(float("-inf")))
    theta = [log(F.col(f"s_{c}") + lam) - log(F.lit(total[f"s_{c}"] + total["v"] * lam)) for c in classes]
    terms = sums.select("term", "n", "df", "idf", F.array(*theta).alias("theta"))
    return NaiveBayesTables(terms, priors, classes, lam)


def model_table(model: NaiveBayesTables) -> DataFrame:
    """Long form (label, term, prior, theta) for the classes seen in training."""
    each = [
        F.struct(F.lit(c).alias("label"), F.lit(p).alias("prior"), F.col("theta")[i].alias("theta"))
        for i, (c, p) in enumerate(zip(model.classes, model.priors, strict=True))
    ]
    return model.terms.select("term", F.inline(F.array(*each))).select("label", "term", "prior", "theta")


def score(
    model: NaiveBayesTables,
    df: DataFrame,
    id_col: str,
    text_col: str = "processed_comment",
    keep: list[str] | None = None,
) -> DataFrame:
    """(id, *keep, score_<class>.., prediction). Rows whose text has no
    vocabulary term score by their prior alone."""
    keep = list(keep or [])
    rows = _doc_terms(df, id_col, text_col, keep, outer=True)
    thetas = [F.col("theta")[i].alias(f"theta_{c}") for i, c in enumerate(model.classes)]
    joined = rows.join(measured_broadcast(model.terms.select("term", "idf", *thetas)), "term", "left")
    weight = F.col("tf") * F.col("idf")
    sums = joined.groupBy(id_col, *keep).agg(
        *[
            # a term with weight 0 adds nothing, whatever its theta
            F.coalesce(F.sum(F.when(weight != 0, weight * F.col(f"theta_{c}"))), F.lit(0.0)).alias(f"m_{c}")
            for c in model.classes
        ]
    )
    scores = {c: F.lit(p) + F.col(f"m_{c}") for c, p in zip(model.classes, model.priors, strict=True)}
    scored = sums.select(id_col, *keep, *[s.alias(f"score_{c}") for c, s in scores.items()])
    columns = [F.col(f"score_{c}") for c in model.classes]
    best = F.greatest(*columns) if len(columns) > 1 else columns[0]
    pred = F.coalesce(*[F.when(F.col(f"score_{c}") == best, F.lit(float(c))) for c in model.classes])
    return scored.withColumn("prediction", pred)
