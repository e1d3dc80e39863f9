"""Word-wrapped previews: literal expectations and properties of the rule."""

import random

import pytest
from pyspark.sql import functions as F

from tonality.functions.preview import hover_2d, hover_3d, preview_2d, preview_3d, wrap_text


def run(spark, texts, settings):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    return [r[0] for r in df.orderBy("id").select(wrap_text(F.col("t"), *settings)).collect()]


# limit 12, width 6, 2 lines
LITERAL = [
    ("", ""),
    ("twelve chars", "twelve chars"),
    ("aa bb cc dd ee", "aa bb<br>cc dd<br>..."),
    ("aa bb cc dd e", "aa bb<br>cc dd<br>..."),
    ("aaaaaaaaaaaaaaa", "aaaaaaaaaaaaaaa"),
    ("aaaaaaaaaaaaaaa b", "aaaaaaaaaaaaaaa<br>b"),
    ("a bbbbbbbbbbbbbb c", "a<br>bbbbbbbbbbbbbb<br>..."),
    ("aaa  bbb \t cc dd ", "aaa<br>bbb cc<br>..."),
    ("   aaaaaa    bbbbbb", "aaaaaa<br>bbbbbb"),
    ("                    ", ""),
]


def test_literal_cases(spark):
    assert run(spark, [t for t, _ in LITERAL], (12, 6, 2)) == [w for _, w in LITERAL]


def test_fixtures(spark):
    a, b, c = "a" * 39, "b" * 50, "c" * 40
    line = "word word word word word word word word"
    got = run(spark, ["short text", f"{a} {b} {c}", "word " * 60], (120, 40, 3))
    assert got == ["short text", f"{a}<br>{b}<br>{c}", f"{line}<br>{line}<br>{line}<br>..."]


@pytest.mark.parametrize("limit, width, lines", [(120, 40, 3), (80, 35, 2)])
def test_properties_of_the_rule(spark, limit, width, lines):
    rng = random.Random(3)
    texts = [" ".join("x" * rng.randint(1, 45) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [" ".join("y" * rng.randint(1, 3) for _ in range(rng.randint(50, 3000))) for _ in range(30)]
    for text, wrapped in zip(texts, run(spark, texts, (limit, width, lines)), strict=True):
        if len(text) <= limit:
            assert wrapped == text
            continue
        words, out = text.split(), wrapped.split("<br>")
        dropped = out[-1] == "..."
        out = out[:-1] if dropped else out
        shown = [w for row in out for w in row.split()]
        assert len(out) <= lines
        assert words[: len(shown)] == shown and dropped == (len(shown) < len(words))
        for i, row in enumerate(out):
            assert len(row) <= width or " " not in row
            after = len([w for r in out[: i + 1] for w in r.split()])
            if after < len(words):  # the next word would not have fitted
                assert len(row) + 1 + len(words[after]) > width


HOVERS = [
    (
        ("Positive", 12, "bad", "Neutral", 1.234, -0.5, 10.0),
        "<b>Positive (12 точек)</b><br><b>Комментарий:</b><br>bad<br>─────────────────────────────<br>"
        "<b>Истинная метка:</b> Neutral<br><b>Предсказание:</b> Positive<br><b>Координаты:</b> (1.23, -0.50, 10.00)",
        "<b>Positive</b><br><b>Комментарий:</b><br>bad<br><b>Истинная метка:</b> Neutral<br><b>Предсказание:</b> Positive",
    ),
    (
        ("Negative", 3, "one two three four five six seven eight nine ten eleven twelve", "Unknown", 0.0, 2.71828, -3.14159),
        "<b>Negative (3 точек)</b><br><b>Комментарий:</b><br>one two three four five six seven eight nine ten eleven twelve<br>"
        "─────────────────────────────<br><b>Истинная метка:</b> Unknown<br><b>Предсказание:</b> Negative<br>"
        "<b>Координаты:</b> (0.00, 2.72, -3.14)",
        "<b>Negative</b><br><b>Комментарий:</b><br>one two three four five six seven eight nine ten eleven twelve<br>"
        "<b>Истинная метка:</b> Unknown<br><b>Предсказание:</b> Negative",
    ),
]


def test_hover_texts(spark):
    rows = [h[0] for h in HOVERS]
    df = spark.createDataFrame(rows, "p string, n long, c string, t string, x double, y double, z double").coalesce(1)
    p, n, c, t, x, y, z = (F.col(k) for k in "pnctxyz")
    got = df.select(hover_3d(p, n, preview_3d(c), t, x, y, z), hover_2d(p, preview_2d(c), t)).collect()
    assert [tuple(r) for r in got] == [h[1:] for h in HOVERS]
