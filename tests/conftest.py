import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quiver.session import build_session, clean_scratch
    shared = tempfile.mkdtemp(prefix="quiver-test-ckpt-", dir="/tmp")  # one machine: its /tmp is shared
    s = build_session("local[8]", shuffle_partitions=8, extra={"spark.checkpoint.dir": f"file://{shared}"})
    yield s
    clean_scratch(s)
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="quiver-test-", dir="/tmp")
