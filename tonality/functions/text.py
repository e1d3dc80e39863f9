"""Text cleaning and tokenizing as native column expressions.

Everything here compiles to JVM expressions: no Python worker is involved.
The rules follow the comment pipeline being re-expressed:

* null text becomes the empty string;
* every character that is not an ASCII letter and not whitespace is deleted
  (not replaced), *then* the text is lower-cased;
* tokens are the whitespace-separated words, with six contractions split;
* English stop words are dropped, and the rest re-joined by one space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: whitespace ------------------------------------------------
# The code points Python's ``str.isspace`` / ``re`` ``\s`` treat as
# whitespace. Java's ``\s`` and RE2's ``\s`` are narrower, so the class is
# spelled out for both dialects.
WHITESPACE_CODEPOINTS = (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# --- fixed values: contractions the word tokenizer splits -------------------
# Only those that contain no apostrophe can survive cleaning. Each splits
# after its third letter.
CONTRACTIONS = {
    "cannot": ("can", "not"),
    "gimme": ("gim", "me"),
    "gonna": ("gon", "na"),
    "gotta": ("got", "ta"),
    "lemme": ("lem", "me"),
    "wanna": ("wan", "na"),
}
# --- fixed values: English stop words ----------------------------------------
# The common English stop-word list, keeping only entries without an
# apostrophe: apostrophes are deleted before matching, so entries such as
# "don't" can never match.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the "
    "and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down "
    "in out on off over under again further then once here there when where "
    "why how all any both each few more most other some such no nor not only "
    "own same so than too very s t can will just don should now d ll m o re "
    "ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn "
    "needn shan shouldn wasn weren won wouldn"
).split()
# -----------------------------------------------------------------------------


def _class_body(codepoints) -> str:
    return "".join(f"\\x{{{c:X}}}" for c in codepoints)


# Character-class bodies (no brackets) for RE2 (DuckDB) and Java (Spark).
WS_RE2 = _class_body(WHITESPACE_CODEPOINTS)
# The same set in Java: ``Character.isWhitespace`` plus the three no-break
# spaces it leaves out and NEL. Equal to the list above on every BMP code
# point (checked by the tests), and about ten times faster to match than
# a class of 29 escaped code points, which Java evaluates as a chain of
# per-character predicates.
WS_JAVA = "\\p{javaWhitespace}\\x85\\xA0\\u2007\\u202F"

# Deletion pattern: runs of anything that is neither an ASCII letter nor
# whitespace (deleting a run at once is the same as deleting each character,
# with far fewer matches).
DELETE_JAVA = f"[^a-zA-Z{WS_JAVA}]+"
DELETE_RE2 = f"[^a-zA-Z{WS_RE2}]"
# Every whitespace code point except the space itself, to map onto a space.
WS_OTHER = "".join(chr(c) for c in WHITESPACE_CODEPOINTS if c != 0x20)
SPLIT_JAVA = f"[{WS_JAVA}]+"
SPLIT_RE2 = f"[{WS_RE2}]+"



def coalesce_text(text: Column) -> Column:
    """Null text becomes the empty string."""
    return F.coalesce(text, F.lit(""))


def clean_text(text: Column) -> Column:
    """Delete non-letters (keeping whitespace), then lower-case."""
    return F.lower(F.regexp_replace(coalesce_text(text), DELETE_JAVA, ""))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a column lambda).

    Column objects are expression trees, so a Python variable used twice is
    computed twice; binding through a one-element ``transform`` avoids that.
    """
    return F.transform(F.array(value), body)[0]


def raw_tokens(cleaned: Column) -> Column:
    """Split on any whitespace: map every whitespace code point to a space
    (``translate``, a per-character table lookup), then split on the space.
    Empty strings remain where whitespace repeats; callers filter them."""
    return F.split(F.translate(cleaned, WS_OTHER, " " * len(WS_OTHER)), " ")


def split_contractions(tokens: Column) -> Column:
    """``gonna`` -> ``gon``, ``na`` and so on, for whole tokens. Only rows that
    hold one of the six words pay for the rewrite."""
    words = F.array(*[F.lit(w) for w in CONTRACTIONS])

    def expand(w):
        out = None
        for word, (a, b) in CONTRACTIONS.items():
            pair = F.array(F.lit(a), F.lit(b))
            out = F.when(w == F.lit(word), pair) if out is None else out.when(w == F.lit(word), pair)
        return out.otherwise(F.array(w))

    return let(
        tokens,
        lambda t: F.when(F.arrays_overlap(t, words), F.flatten(F.transform(t, expand))).otherwise(t),
    )


def content_tokens(cleaned: Column, stop_words=None) -> Column:
    """Word tokens without empty strings and stop words, in one array filter."""
    stop = list(STOP_WORDS if stop_words is None else stop_words)
    return F.filter(
        split_contractions(raw_tokens(cleaned)), lambda w: (w != F.lit("")) & ~w.isin(stop)
    )


def process_text(cleaned: Column, stop_words=None) -> Column:
    """Tokenize, drop stop words and re-join with one space."""
    return F.array_join(content_tokens(cleaned, stop_words), " ")


def ml_tokens(text: Column) -> Column:
    """Tokens as Spark ML's ``Tokenizer`` makes them: lower-case, split on one
    whitespace character. Empty text yields one empty token."""
    return F.split(F.lower(text), "\\s")


def strip_unicode(text: Column) -> Column:
    """Strip leading and trailing whitespace of any kind (``str.strip``).

    A character-set trim looks at each end once; a regular expression anchored
    at the end would start over at every space inside the text."""
    return F.btrim(text, F.lit(" " + WS_OTHER))


def has_text(text: Column) -> Column:
    """Is there a character that isn't whitespace? Stops at the first one."""
    return F.coalesce(text.rlike(f"[^{WS_JAVA}]"), F.lit(False))


def preview_source(text: Column) -> Column:
    """Preview input: stripped, then newline and carriage return to spaces."""
    return F.translate(strip_unicode(F.coalesce(text.cast("string"), F.lit("None"))), "\n\r", "  ")


def is_empty(processed: Column) -> Column:
    return processed == F.lit("")


# ---- SQL text (DuckDB dialect) for the oracle queries ----------------------


def sql_quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_clean(expr: str) -> str:
    return f"lower(regexp_replace(coalesce({expr}, ''), '{DELETE_RE2}', '', 'g'))"


def sql_word_tokens(cleaned_expr: str) -> str:
    cases = " ".join(
        f"WHEN '{w}' THEN ['{a}', '{b}']" for w, (a, b) in CONTRACTIONS.items()
    )
    return (
        "flatten(list_transform(list_filter(regexp_split_to_array("
        f"{cleaned_expr}, '{SPLIT_RE2}'), lambda w: w <> ''), "
        f"lambda w: CASE w {cases} ELSE [w] END))"
    )


def sql_content_tokens(cleaned_expr: str, stop_words=None) -> str:
    stop = ", ".join(sql_quote(w) for w in (STOP_WORDS if stop_words is None else stop_words))
    return f"list_filter({sql_word_tokens(cleaned_expr)}, lambda w: w NOT IN ({stop}))"


def sql_process(cleaned_expr: str, stop_words=None) -> str:
    return f"array_to_string({sql_content_tokens(cleaned_expr, stop_words)}, ' ')"
