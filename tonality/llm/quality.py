"""Quality rules as a bitmask ledger, in native column expressions only.

Each rule is evaluated once per document. The ledger keeps the measurements
and one failure bit per rule; a policy is a versioned set of rules, applied
later as a mask, so changing a policy never re-reads the texts. Ablations
(what does a rule add to a policy?) come from bitwise aggregates of the bits.

Defined results: a null or word-less text has zero counts and fails
``few_words``; rows are judged one by one, so repeated rows, repeated or null
ids give one ledger row each; an empty table gives an empty ledger; an input
column named like a ledger column (in any letter case) is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, let, text_or_empty, without, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rule name -> (failure test over the measurements). The position is the bit.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_words": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "5 * n_symbols > n_words",
    "shouting": "10 * n_upper > 3 * word_chars",
    "repeated_lines": "n_lines >= 4 AND 2 * n_dup_lines > n_lines",
    "odd_word_length": "2 * word_chars < 5 * n_words OR word_chars > 15 * n_words",
}

#: Policy version -> the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "many_symbols", "shouting"),
    "v2": tuple(RULES),
}


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def _repeated_words(word_list: Column) -> Column:
    """Words covered by 8-word windows that occur twice or more in the list."""

    def windows(h: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(h) - WINDOW)
        return F.when(
            F.size(h) >= WINDOW,
            F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])),
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(p: Column) -> Column:  # p: sorted starts of repeated windows
        reach = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0), lambda a, x: a + x)

    def starts(s: Column) -> Column:  # s: windows sorted by fingerprint
        same = lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
            F.get(s, j + 1)["h"] == x["h"], F.lit(False)
        )
        return F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))

    def repeated(v: Column) -> Column:
        pairs = F.sort_array(F.transform(v, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(v)) == F.size(v), F.lit(0)).otherwise(
            let(pairs, lambda s: let(starts(s), covered))
        )

    hashes = F.transform(word_list, lambda w: F.xxhash64(w))
    return let(let(hashes, windows), repeated)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measurements, each a long."""
    t = text_or_empty(text)
    counts = let(words(t), lambda w: F.struct(F.size(w).alias("n"), _repeated_words(w).alias("r")))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(WHITE))) > 0)
    line_counts = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    length = F.length(t)
    found = F.struct(
        counts.alias("words"),
        line_counts.alias("lines"),
        F.length(F.translate(t, WHITE, "")).alias("word_chars"),
        (length - F.length(F.translate(t, SYMBOLS, ""))).alias("n_symbols"),
        (length - F.length(F.translate(t, UPPER, ""))).alias("n_upper"),
    )
    m = F.col("_measured")
    values = {
        "n_words": m["words"]["n"],
        "word_chars": m["word_chars"],
        "n_symbols": m["n_symbols"],
        "n_upper": m["n_upper"],
        "n_lines": m["lines"]["n"],
        "n_dup_lines": m["lines"]["n"] - m["lines"]["d"],
        "n_repeat_words": m["words"]["r"],
    }
    # inline() of a one-element array is a generator: it is evaluated once per
    # row, and no later projection can be merged into it
    kept = without(df, "_measured", *MEASURES) if text not in MEASURES else df
    once = kept.select("*", F.explode(F.array(found)).alias("_measured"))
    return once.select(*kept.columns, *[v.cast("long").alias(k) for k, v in values.items()])


def ledger(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measurements and ``failure_bits`` (long): bit i is set if
    the i-th rule of ``RULES`` fails."""
    measured = measure(without(df, "failure_bits"), text)
    bits = sum((F.when(F.expr(test), F.lit(bit(rule))).otherwise(F.lit(0)) for rule, test in RULES.items()), F.lit(0))
    return measured.withColumn("failure_bits", bits.cast("long"))


def passes(policy: str) -> Column:
    """Does a ledger row pass the policy?"""
    return F.col("failure_bits").bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policy: str) -> DataFrame:
    """What each rule of a policy does: documents it fails, those that only it
    fails (they'd be kept without it), and the bits that ever fail beside it.

    The documents are first counted by bit pattern, at most ``2**len(RULES)``
    rows; everything else is bitwise work on those.
    """
    active = F.col("failure_bits").bitwiseAND(F.lit(mask(policy)))
    patterns = rows.groupBy(active.alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("b")) for r in POLICIES[policy]]))
    each = patterns.select("bits", "n", rules.alias("x")).select("bits", "n", "x.*")
    hit = F.col("bits").bitwiseAND(F.col("b")) != 0
    alone = F.col("bits") == F.col("b")
    return each.groupBy("rule", "b").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("n_only_this"),
        F.coalesce(F.bit_or(F.when(hit, F.col("bits").bitwiseXOR(F.col("b")))), F.lit(0)).alias("fails_beside"),
    ).withColumnRenamed("b", "rule_bit")


def quality_filter(df: DataFrame, policy: str = "v2", text: str = "text") -> DataFrame:
    """The rows of ``df`` that pass the policy, with the columns of ``df``."""
    judged = ledger(df.select(F.struct("*").alias("row"), F.col(text).alias("text")))
    return judged.where(passes(policy)).select("row.*")


def quality_report(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """Ledger, base verdict and policy verdict of each document."""
    return (
        ledger(docs.select("doc_id", "text"))
        .withColumn("base_failed", ~passes("base"))
        .withColumn("kept", passes(policy))
        .drop("text")
    )
