import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohort.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("cohort-tests", master="local[*]", shuffle_partitions=8,
                    conf={"spark.driver.memory": "6g"})
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohort-test-ckpt-", dir="/tmp"))
    yield s
    s.stop()
