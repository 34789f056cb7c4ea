import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from marketlake.session import build_session
    s = build_session("local[4]", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="marketlake-test-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
