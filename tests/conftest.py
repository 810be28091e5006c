import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    scratch = tempfile.mkdtemp(prefix="tessera-test-")
    s = get_session(master="local[4]", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": scratch + "/ckpt", "spark.local.dir": scratch + "/local",
                           "spark.driver.memory": "4g"})
    s.sparkContext.setCheckpointDir(scratch + "/ckpt")
    yield s


SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
