"""The shared folder: named by the launcher, made here only in local mode."""

import os
import subprocess
import sys
import tempfile

import duckdb
import pytest

from tonality import session

from conftest import SF001

PLAIN = """
import sys
from tonality import session
from tonality.plans.catalog import QUERIES
spark = session.build_session("local[2]", shuffle_partitions=2)
assert not spark.conf.get("spark.checkpoint.dir", None)
print("rows", QUERIES["class_slice"](spark, sys.argv[1]).count())
session.remove_scratch(spark)
"""


def plain_run(*args):
    """A fresh process whose Spark configuration folder is empty."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = os.environ | {"SPARK_CONF_DIR": tempfile.mkdtemp(prefix="tonality-conf-"), "PYTHONPATH": root}
    env.pop("PYSPARK_SUBMIT_ARGS", None)
    done = subprocess.run([sys.executable, *args], capture_output=True, text=True, env=env, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


def test_a_query_runs_without_the_setting():
    labels, docs = (duckdb.sql(f"SELECT doc_id FROM '{SF001}/{t}.parquet'").fetchall() for t in ("labels", "documents"))
    expected = sum(x in set(docs) for x in labels)
    assert f"rows {expected}\n" in plain_run("-c", PLAIN, SF001)


def test_a_stage_runs_without_the_setting(tmp_dir):
    with open(f"{tmp_dir}/c.csv", "w", encoding="utf-8") as f:
        f.write("Comment,Sentiment\ngood film,positive\nbad film,negative\n")
    plain_run("-m", "tonality", "preprocess", f"{tmp_dir}/c.csv", f"{tmp_dir}/out", "--mode", "strict")
    assert os.path.exists(f"{tmp_dir}/out/_SUCCESS")


@pytest.mark.parametrize("master, local", [("local", True), ("local[*]", True), ("local[4,2]", True), ("local-cluster[2,1,1024]", False),
                                           ("yarn", False), ("spark://host:7077", False), ("k8s://https://x", False)])
def test_is_local(master, local):
    assert session.is_local(master) is local


class Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class Session:
    sparkContext = Context()

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_without_the_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_scratch_paths_lie_in_the_folder_and_differ(spark):
    base = session.scratch_dir(spark)
    assert base.startswith(session.shared_dir(spark) + "/")
    a, b = session.scratch_path(spark, "x"), session.scratch_path(spark, "x")
    assert a != b and a.startswith(base + "/x-")


def test_scratch_can_be_removed(spark, monkeypatch):
    monkeypatch.setattr(session, "scratch_dir", lambda s: session.shared_dir(s) + "/own-folder")
    path = session.scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    session.remove_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    session.remove_scratch(spark)
