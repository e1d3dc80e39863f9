"""Stream = batch, restart adds nothing; driver contract."""

import os
import shutil

import pytest

from tonality.plans.catalog import QUERIES, sentiment_model
from tonality.schema import CONVERSATIONS
from tonality.streaming.score_stream import OUTPUT_COLUMNS, run_available
from tonality.operators.scoring import drop_blank, score_texts
from tonality.sources.comments import conversation_texts

from conftest import SF001


def test_stream_equals_batch_and_restart_is_idempotent(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    shutil.copy(f"{SF001}/conversations.parquet", os.path.join(src, "part-0.parquet"))
    model = sentiment_model(spark, SF001)
    sink, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    run_available(model, spark, src, sink, ckpt)
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).select(*OUTPUT_COLUMNS).collect())
    batch = sorted(
        tuple(r) for r in score_texts(model, drop_blank(conversation_texts(spark, SF001))).select(*OUTPUT_COLUMNS).collect()
    )
    assert streamed == batch and len(batch) > 0
    run_available(model, spark, src, sink, ckpt)
    assert spark.read.parquet(sink).count() == len(batch)


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 3
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 30


def test_stream_picks_up_only_new_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    conv = spark.read.parquet(f"{SF001}/conversations.parquet")
    first = conv.where("conv_id % 2 = 0")
    second = conv.where("conv_id % 2 = 1")
    first.coalesce(1).write.parquet(os.path.join(src, "batch-1"))
    model = sentiment_model(spark, SF001)
    sink, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    from tonality.streaming.score_stream import run_available as run

    run(model, spark, os.path.join(src, "batch-1"), sink, ckpt)
    n1 = spark.read.parquet(sink).count()
    # a new file arrives in the watched directory
    second.coalesce(1).write.mode("overwrite").parquet(os.path.join(tmp_dir, "staging"))
    staged = [f for f in os.listdir(os.path.join(tmp_dir, "staging")) if f.endswith(".parquet")]
    shutil.copy(os.path.join(tmp_dir, "staging", staged[0]), os.path.join(src, "batch-1", "part-new.parquet"))
    run(model, spark, os.path.join(src, "batch-1"), sink, ckpt)
    out = spark.read.parquet(sink)
    blank = drop_blank(conv).count()
    assert n1 == drop_blank(first).count()
    assert out.count() == blank
    assert out.select("conv_id", "turn").distinct().count() == blank


@pytest.mark.parametrize("parts", [None, 3])
def test_scored_stream_reads_a_table_of_one_file_or_of_many(spark, tmp_dir, parts):
    """A folder of part files next to tables with similar names."""
    words = ["good fine day", "bad awful mess", "plain table text"]
    docs = [(i, f"{words[i % 3]} number{i % 7}") for i in range(90)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    labels = [(i, int(i % 3 == 0), int(i % 3 == 1)) for i in range(90)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    texts = [(i // 4, i % 4, "user", None if i == 5 else " " if i == 6 else words[i % 3]) for i in range(40)]
    talk = spark.createDataFrame(texts, CONVERSATIONS)
    if parts is None:
        talk.toPandas().to_parquet(f"{tmp_dir}/conversations.parquet")
    else:
        talk.repartition(parts).write.parquet(f"{tmp_dir}/conversations.parquet")
    talk.limit(3).write.parquet(f"{tmp_dir}/conversations_old.parquet")
    assert QUERIES["score_stream"](spark, tmp_dir).count() == 38
    assert tuple(QUERIES["stream_check"](spark, f"{tmp_dir}/").first()) == (38, 0, 0)
