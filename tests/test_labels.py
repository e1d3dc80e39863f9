"""Label encoding (L1-L6), decoding and CSV read modes (Q8)."""

from pyspark.sql import functions as F

from tonality.functions.labels import decode_label, encode_label
from tonality.sources.comments import read_comments_csv, split_corrupt


def test_encode(spark):
    rows = [("L1", "positive", 2), ("L2", "neutral", 1), ("L3", "negative", 0), ("L4", None, 0), ("L5", "Positive", 0), ("L6", "positive ", 0)]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "id string, Sentiment string")
    got = {r["id"]: r["label"] for r in df.select("id", encode_label(F.col("Sentiment")).alias("label")).collect()}
    assert got == {a: c for a, _, c in rows}


def test_decode(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (7.0,)], "p double")
    got = [r[0] for r in df.select(decode_label(F.col("p"))).collect()]
    assert got == ["Negative", "Neutral", "Positive", "Unknown"]


CSV = 'Comment,Sentiment\n"line one\nline two",positive\nplain,Positive\n"say ""hi"", ok",neutral\n'


def test_csv_modes(spark, tmp_dir):
    path = f"{tmp_dir}/comments.csv"
    with open(path, "w") as f:
        f.write(CSV)
    compat = read_comments_csv(spark, path, "compat").collect()
    assert len(compat) == 4
    assert (compat[0]["Comment"], compat[0]["Sentiment"]) == ("line one", None)
    strict = read_comments_csv(spark, path, "strict").cache()
    good, bad = split_corrupt(strict)
    got = sorted((r["Comment"], r["Sentiment"]) for r in good.collect())
    assert got == sorted([("line one\nline two", "positive"), ("plain", "Positive"), ('say "hi", ok', "neutral")])
    assert bad.count() == 0
