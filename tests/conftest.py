import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugeflow.session import build_session, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="gaugeflow-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only where the session has none.
    checkpoint_root(s, fallback=tempfile.mkdtemp(prefix="gaugeflow-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="gaugeflow-test-")


SF_SMALL = "/root/testdata/sf0.001"
