"""Strict CSV read in splits: the same records as the multi-line reader's."""

import os
import random

import pytest

from tonality.schema import CORRUPT_COLUMN, RAW_COMMENTS_STRICT
from tonality.sources.comments import read_comments_csv
from tonality.sources.strict_csv import inside_after, read_strict_splits

FIELDS = ["plain", "with, comma", "line\nbreak", "two\n\nbreaks", 'say "hi"', '"', "\n", "\r\n mix", "é ü 你好", "", " lead", "trail ", 'a "b" , c\n"d"', "x" * 50]


def quoted(text):
    return '"' + text.replace('"', '""') + '"'


def write(path, seed, n, eol, odd=True, last=True):
    r = random.Random(seed)
    lines = ["Comment,Sentiment"]
    for i in range(n):
        f = [quoted(x) if any(c in x for c in ',"\n\r') or r.random() < 0.3 else x for x in (r.choice(FIELDS), r.choice(["positive", "neutral", "odd,one"]))]
        if odd and i % 37 == 0:
            f = f[:1]
        if odd and i % 41 == 0:
            f.append("third")
        if odd and i % 43 == 0:
            f[0] = '5" disk'
        if odd and i % 47 == 0:
            f[0] = '"ab"cd'
        lines.append(",".join(f))
        if odd and i % 29 == 0:
            lines.append("")
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write(eol.join(lines) + (eol if last else ""))


@pytest.fixture
def splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield of
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [1 << 27, 900, 64])
@pytest.mark.parametrize("eol, last", [("\n", True), ("\n", False), ("\r\n", True)])
def test_equal_to_the_multi_line_reader(spark, tmp_dir, splits, size, eol, last):
    write(f"{tmp_dir}/a.csv", 1, 200, eol, last=last)
    write(f"{tmp_dir}/b.csv", 2, 30, eol, last=last)
    expected = sorted(map(str, read_comments_csv(spark, tmp_dir, "strict").collect()))
    splits(size)
    df = read_strict_splits(spark, tmp_dir, RAW_COMMENTS_STRICT, CORRUPT_COLUMN)
    assert sorted(map(str, df.collect())) == expected
    if size == 64:
        assert df.rdd.getNumPartitions() > 50


def test_a_record_over_many_splits(spark, tmp_dir, splits):
    long = "\n".join(f'line "{i}", more' for i in range(100))
    with open(f"{tmp_dir}/a.csv", "w", encoding="utf-8", newline="") as out:
        out.write(f"Comment,Sentiment\nfirst,positive\n{quoted(long)},negative\nlast,neutral\n")
    splits(100)
    rows = read_comments_csv(spark, f"{tmp_dir}/a.csv", "splits").drop(CORRUPT_COLUMN).collect()
    assert sorted(map(tuple, rows)) == sorted([("first", "positive"), (long, "negative"), ("last", "neutral")])


def test_changed_splits_are_an_error_not_a_wrong_result(spark, tmp_dir, splits):
    write(f"{tmp_dir}/a.csv", 3, 100, "\n", odd=False)
    splits(100)
    df = read_strict_splits(spark, f"{tmp_dir}/a.csv", RAW_COMMENTS_STRICT, CORRUPT_COLUMN)
    splits(170)
    with pytest.raises(Exception, match="splits of the file changed"):
        df.count()
    assert read_strict_splits(spark, f"{tmp_dir}/a.csv", RAW_COMMENTS_STRICT, CORRUPT_COLUMN).count() == 100


def test_empty_files_and_headers_alone(spark, tmp_dir):
    os.mkdir(f"{tmp_dir}/d")
    open(f"{tmp_dir}/d/empty.csv", "w").close()
    with open(f"{tmp_dir}/d/head.csv", "w") as out:
        out.write('Comment,"Senti\nment"\n')
    assert read_comments_csv(spark, f"{tmp_dir}/d", "splits").collect() == []


@pytest.mark.parametrize("line, outside, within", [
    ("plain, text", False, True), ('"open', True, False), ('close",x', False, False), ('a "stray, quote', False, False), ('"a""b","c', True, True),
    ('"', True, False), ('""', False, True), ('x""y', False, True), (',"', True, False), ('"a"b"c,d', False, False)])
def test_state_after_a_line(line, outside, within):
    assert inside_after(line, False) is outside
    if '"' in line:
        assert inside_after(line, True) is within
