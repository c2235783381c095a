import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from searchlens.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    shared = "file://" + tempfile.mkdtemp(prefix="searchlens-ckpt-")
    s = local_session(cores="*", shuffle_partitions=8, app="searchlens-tests", extra_conf={"spark.checkpoint.dir": shared})
    yield s
    s.stop()
