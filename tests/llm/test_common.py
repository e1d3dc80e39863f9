import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tonality.llm.common import bounded_batches, let, materialise, words
from tonality.llm.kernels import Powers, Words, is_word_byte_table, key_runs, runs_of, slices

from .helpers import ROWS, ascii_words

TEXTS = [t for _, t in ROWS] + ["a", " a", "a ", "é ü\x1ca", "x" * 300, "\x00 \x00"]


def test_batches_are_bounded_in_bytes(spark):
    def rows(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    old = {k: spark.conf.get(f"spark.sql.execution.arrow.{k}") for k in ("maxBytesPerBatch", "maxRecordsPerBatch")}
    bounded_batches(spark)
    try:
        df = spark.range(0, 40, numPartitions=1).select(F.repeat(F.lit("x"), 1_000_000).alias("t"))
        counts = [r.n for r in df.mapInArrow(rows, "n long").collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(f"spark.sql.execution.arrow.{k}", v)
    assert sum(counts) == 40 and max(counts) <= 6


def test_words_equal_python_split(spark):
    w = Words(pa.array(TEXTS), Powers(), is_word_byte_table())
    keys = {}
    for i, t in enumerate(TEXTS):
        own = [w.word(k) for k in range(w.first[i], w.first[i + 1])]
        assert own == ascii_words(t)
        for k, word in zip(range(w.first[i], w.first[i + 1]), own, strict=True):
            assert keys.setdefault(word, int(w.key[k])) == int(w.key[k])
    assert len(set(keys.values())) == len(keys)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    native = df.select("i", words(F.coalesce("t", F.lit(""))).alias("w")).orderBy("i").collect()
    assert [[x.encode() for x in r.w] for r in native] == [ascii_words(t) for t in TEXTS]


def test_slices_hold_all_rows_and_do_not_change_fingerprints():
    batch = pa.RecordBatch.from_arrays([pa.array(TEXTS), pa.array(range(len(TEXTS)))], ["text", "i"])
    whole = Words(batch.column("text"), Powers(), is_word_byte_table())
    for size in (1, 50, 10_000):
        parts = list(slices(batch, "text", size))
        assert [x for p in parts for x in p.column("i").to_pylist()] == list(range(len(TEXTS)))
        keys = [Words(p.column("text"), Powers(), is_word_byte_table()).key for p in parts]
        assert (np.concatenate(keys) == whole.key).all()


def test_runs_of_words():
    w = Words(pa.array(["a b c d", "a b c", "b c", "a", "", None, "x a b c"]), Powers(), is_word_byte_table())
    key, before = runs_of(w.key, w.first, 3, 12345 | 1)
    assert np.diff(before).tolist() == [2, 1, 1, 1, 0, 0, 2]
    assert key[0] == key[2] == key[6] and len(set(key.tolist())) == 5


def test_key_runs_join_batches():
    batches = [pa.RecordBatch.from_arrays([pa.array(x)], ["k"]) for x in ([1, 1, 2], [2], [], [2, 3], [3, 3, 4])]
    assert [t.column("k").to_pylist() for t in key_runs(iter(batches), ["k"])] == [[1, 1], [2, 2, 2], [3, 3, 3], [4]]


def test_let_evaluates_once_and_binds(spark):
    row = spark.range(1).select(let(F.rand(), lambda x: F.struct(x.alias("a"), x.alias("b"))).alias("r")).first()
    assert row.r.a == row.r.b


def test_materialised_rows_stay_the_same(spark):
    df = materialise(spark.range(50).repartition(3).withColumn("r", F.rand()), "x")
    assert sorted(df.collect()) == sorted(df.collect())
    assert materialise(spark.range(0), "none").count() == 0
