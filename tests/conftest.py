import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from textforge.session import get_session

    s = get_session(master="local[*]", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tf-test-ckpt-", dir="/tmp"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tf-test-", dir="/tmp")


SF_SMALL = "/root/testdata/sf0.001"
