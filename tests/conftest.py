import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from chronoset.session import create_session

    s = create_session(
        "chronoset-tests",
        master="local[4]",
        conf={"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    # tests own the session: set a checkpoint folder only when none is configured
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="chronoset-test-ckpt-"))
    yield s
