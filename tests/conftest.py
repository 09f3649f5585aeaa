import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from voltaic.session import build_session
    scratch = tempfile.mkdtemp(prefix="voltaic-test-")
    s = build_session(master="local[*]", app="voltaic-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": f"{scratch}/ckpt"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="voltaic-t-")
