"""A training corpus from raw documents: five stages, each on all that its
predecessor kept. Every stage but the last returns the columns of documents.

Defined results, for every stage: a null text counts as empty, and quality rules
reject it; near dedup keeps rows without an id, and substring dedup, mixing and
packing take them like others; the first document of a group is the one with the
smallest id, and rows that share an id stay or go together there; repeated rows
are cut alike, as no passage is judged against a document of the same id; very
long texts are processed whole; an empty table gives an empty result; extra
columns pass through under their names, whatever those are, up to packing, which
returns pieces.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonality.llm.common import materialise, table
from tonality.llm.minhash import drop_near_duplicates
from tonality.llm.mixing import thin
from tonality.llm.packing import pack
from tonality.llm.quality import quality_filter
from tonality.llm.substring import remove_repeats

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the latest quality policy."""
    return quality_filter(docs, "v2")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words that occur in an earlier document.
    A text that loses nothing stays as it is; one that loses all its words goes."""
    taken = {c.lower() for c in docs.columns}
    whole = next(name for i in itertools.count() if (name := f"text_{i}") not in taken)
    cut = remove_repeats(docs.select("*", F.col("text").alias(whole)))
    text = F.when(F.col("n_removed") == 0, F.col("rest")[whole]).otherwise(F.col("kept_text"))
    rows = cut.where("n_removed = 0 OR n_removed < n_words")
    present = [
        text.alias(c)
        if c == "text"
        else F.when(F.col("n_removed") == 0, F.col("rest.n_chars")).otherwise(F.length("kept_text")).alias(c)
        if c == "n_chars"
        else F.col("rest")[c].alias(c)
        for c in docs.columns
    ]
    return rows.select(*present)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that the clean and low-quality domains keep their
    tokens and the toxic domain loses its own."""
    return thin(docs, table(spark, sf_dir, "labels"), keep={"clean": 1.0, "low": 1.0, "toxic": 0.0})


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens, as pieces of documents."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: The stages sample, train and hash: SQL can't express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if i == len(STAGES) - 1 else materialise(out, name.replace(" ", "-"))
    return docs
