import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tramspark.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app="tramspark-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tramspark-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_sf001():
    from tools.compare import duck
    return duck("/root/testdata/sf0.001")
