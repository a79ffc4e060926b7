import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from flowlens.session import get_session
    s = get_session(master="local[*]", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="flowlens-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from flowlens.plans import model
    return model.build_tables(spark, SF_SMALL)


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="flowlens-test-")
