"""Spark session and shared-folder helpers.

On a cluster the session is created by the launcher and only read here; the
builder below is for local runs and tests.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark options.
DEFAULT_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Arrow batches for the few pandas UDFs.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    # Long texts make large rows: batches are bounded in bytes too.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "tonality",
    shuffle_partitions: int = 8,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """Do all tasks run in the driver's process? (``local-cluster`` does not.)"""
    return re.fullmatch(r"local(\[[^\]]*\])?", master) is not None


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it is set by the launcher and points to storage every
    executor can reach; without it this raises. Only in local mode, where all
    tasks run in this process, is a fresh local folder made (and removed when
    the process ends).
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tonality-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared folder."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the scratch folder (intermediate tables, sinks,
    stream checkpoints)."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to its scratch folder. Call it when
    no DataFrame made from intermediate tables is needed any more; the shared
    folder may be any file system that Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
