"""Small tables with the awkward rows every operator must take."""

import random

WORDS = [f"w{i}" for i in range(400)]


def sentence(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def swapped(text, seed, share):
    """A near copy: some words replaced."""
    r = random.Random(seed)
    return " ".join(f"x{seed}y{i}" if r.random() < share else w for i, w in enumerate(text.split()))


BASE = sentence(1, 120)
ROWS = [
    (1, BASE),
    (2, BASE),  # an exact copy
    (3, swapped(BASE, 3, 0.02)),  # a near copy
    (4, None),
    (5, ""),
    (6, " \t\n\x0b\x0c\r "),
    (7, "one two"),
    (8, "one two"),
    (9, sentence(9, 60) + " " + " ".join(BASE.split()[20:90])),  # shares a passage
    (10, sentence(10, 20_000)),  # very long
    (11, "Grüße, 你好 naïve nbsp.\nGrüße, 你好\nGrüße, 你好"),
    (12, "again again again again again again again again again again again again " * 5),
    (None, BASE),
    (None, None),
    (13, sentence(13, 70)),
    (13, sentence(13, 70)),  # a repeated row
    (14, sentence(13, 70) + " tail"),
]
#: Extra columns that clash with names the operators use inside.
EXTRA = "n_words long, rest string, row string, copy long, band long, n_tokens long, failure_bits long, rate double"


def edge_docs(spark):
    rows = [(d, t, 1, "r", "w", 2, 3, 4, 5, 0.5) for d, t in ROWS]
    return spark.createDataFrame(rows, f"doc_id long, text string, {EXTRA}")


def empty_docs(spark):
    return spark.createDataFrame([], f"doc_id long, text string, {EXTRA}")


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def ascii_words(text):
    return (text or "").encode().split()  # splits at space and U+0009 to U+000D
