import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tonality.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8, app_name="tonality-tests")
    # tests own their shared folder; a cluster names it in spark.checkpoint.dir
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tonality-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="tonality-test-")
