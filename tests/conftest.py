import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vigil.session import build_session

    s = build_session(app="vigil-tests", master="local[4]", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vigil-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from vigil.session import scratch_path

    return lambda name: scratch_path(spark, name)
