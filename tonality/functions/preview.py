"""Chart hover text: word-wrapped comment previews and the hover label.

The wrap is a left fold over the words (``aggregate`` with a struct state),
so it stays a JVM expression evaluated row by row.

Wrap rule (limit L, width W, at most K lines): text of at most L characters
is unchanged. Longer text is split on whitespace and filled greedily into
lines of at most W characters; a word longer than W stands alone on its line.
When a word would open line K + 1, ``...`` is added and the rest dropped.
Lines are joined with ``<br>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPLIT_JAVA, SPLIT_RE2, WS_RE2

# --- fixed values: preview settings and hover format -------------------------
PREVIEW_3D = (120, 40, 3)  # limit, width, lines
PREVIEW_2D = (80, 35, 2)
ELLIPSIS = "..."
LINE_BREAK = "<br>"
HOVER_POINTS = "точек"
HOVER_COMMENT = "<b>Комментарий:</b><br>"
HOVER_RULE = "─────────────────────────────<br>"
HOVER_TRUE = "<b>Истинная метка:</b> "
HOVER_PRED = "<b>Предсказание:</b> "
HOVER_COORDS = "<b>Координаты:</b> "
# -----------------------------------------------------------------------------

def words_needed(width: int, max_lines: int) -> int:
    """Upper bound on the words the wrap can look at: a line holds at most
    (width + 1) // 2 words, and the word that would open line K + 1 ends it."""
    return max_lines * ((width + 1) // 2) + 1


def wrap_text(text: Column, limit: int, width: int, max_lines: int) -> Column:
    # Only the first ``n`` words can matter, so the split stops there (the
    # last array entry holds the unsplit rest and is cut off): the cost per
    # row is bounded whatever the document length.
    n = words_needed(width, max_lines)
    parts = F.split(text, SPLIT_JAVA, n + 2)
    words = F.slice(F.filter(parts, lambda w: w != F.lit("")), 1, n)
    init = F.struct(
        F.array().cast("array<string>").alias("lines"),
        F.lit("").alias("cur"),
        F.lit(False).alias("done"),
    )

    def step(acc, w):
        lines, cur, done = acc["lines"], acc["cur"], acc["done"]
        fits = F.length(cur) + F.lit(1) + F.length(w) <= F.lit(width)
        pushed = F.concat(lines, F.array(cur))
        full = F.size(pushed) >= F.lit(max_lines)
        return (
            F.when(done, acc)
            .when(cur == F.lit(""), F.struct(lines.alias("lines"), w.alias("cur"), F.lit(False).alias("done")))
            .when(fits, F.struct(lines.alias("lines"), F.concat(cur, F.lit(" "), w).alias("cur"), F.lit(False).alias("done")))
            .otherwise(
                F.struct(
                    F.when(full, F.concat(pushed, F.array(F.lit(ELLIPSIS)))).otherwise(pushed).alias("lines"),
                    w.alias("cur"),
                    full.alias("done"),
                )
            )
        )

    def finish(acc):
        lines, cur = acc["lines"], acc["cur"]
        out = F.when((cur != F.lit("")) & (F.size(lines) < F.lit(max_lines)), F.concat(lines, F.array(cur))).otherwise(lines)
        return F.array_join(out, LINE_BREAK)

    wrapped = F.aggregate(words, init, step, finish)
    return F.when(F.length(text) <= F.lit(limit), text).otherwise(wrapped)


def preview_3d(text: Column) -> Column:
    return wrap_text(text, *PREVIEW_3D)


def preview_2d(text: Column) -> Column:
    return wrap_text(text, *PREVIEW_2D)


def coord(x: Column) -> Column:
    return F.format_string("%.2f", x.cast("double"))


def hover_3d(pred_name: Column, class_size: Column, comment: Column, true_name: Column, x, y, z) -> Column:
    return F.concat(
        F.lit("<b>"), pred_name, F.lit(" ("), class_size.cast("string"), F.lit(f" {HOVER_POINTS})</b><br>"),
        F.lit(HOVER_COMMENT), comment, F.lit("<br>"),
        F.lit(HOVER_RULE),
        F.lit(HOVER_TRUE), true_name, F.lit("<br>"),
        F.lit(HOVER_PRED), pred_name, F.lit("<br>"),
        F.lit(HOVER_COORDS + "("), coord(x), F.lit(", "), coord(y), F.lit(", "), coord(z), F.lit(")"),
    )


def hover_2d(pred_name: Column, comment: Column, true_name: Column) -> Column:
    return F.concat(
        F.lit("<b>"), pred_name, F.lit("</b><br>"),
        F.lit(HOVER_COMMENT), comment, F.lit("<br>"),
        F.lit(HOVER_TRUE), true_name, F.lit("<br>"),
        F.lit(HOVER_PRED), pred_name,
    )


# ---- SQL text (DuckDB dialect) --------------------------------------------------


def sql_wrap(expr: str, limit: int, width: int, max_lines: int) -> str:
    words = f"list_filter(regexp_split_to_array({expr}, '{SPLIT_RE2}'), lambda w: w <> '')"
    init = "{'lines': []::VARCHAR[], 'cur': '', 'done': false}"
    pushed = "list_append(acc.lines, acc.cur)"
    full = f"len({pushed}) >= {max_lines}"
    step = (
        "lambda acc, w: CASE "
        "WHEN acc.done THEN acc "
        "WHEN acc.cur = '' THEN {'lines': acc.lines, 'cur': w, 'done': false} "
        f"WHEN length(acc.cur) + 1 + length(w) <= {width} THEN {{'lines': acc.lines, 'cur': acc.cur || ' ' || w, 'done': false}} "
        f"ELSE {{'lines': CASE WHEN {full} THEN list_append({pushed}, '{ELLIPSIS}') ELSE {pushed} END, "
        f"'cur': w, 'done': {full}}} END"
    )
    folded = f"list_reduce({words}, {step}, {init})"
    finish = (
        f"array_to_string(CASE WHEN s.cur <> '' AND len(s.lines) < {max_lines} "
        f"THEN list_append(s.lines, s.cur) ELSE s.lines END, '{LINE_BREAK}')"
    )
    # bind the folded state to ``s`` through a one-element list
    return (
        f"CASE WHEN length({expr}) <= {limit} THEN {expr} ELSE "
        f"list_transform([{folded}], lambda s: {finish})[1] END"
    )


def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^[{WS_RE2}]+|[{WS_RE2}]+$', '', 'g')"


def sql_preview_source(expr: str) -> str:
    """Stripped, newline and carriage return to spaces (null reads ``None``)."""
    stripped = sql_strip(f"coalesce({expr}, 'None')")
    return f"translate({stripped}, chr(10) || chr(13), '  ')"

