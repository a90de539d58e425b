import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from starloom.session import build_session

    scratch = tempfile.mkdtemp(prefix="starloom-test-")
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": f"{scratch}/ckpt", "spark.local.dir": f"{scratch}/local",
                             "spark.driver.memory": "4g"})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
