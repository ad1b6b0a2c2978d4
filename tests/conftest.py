import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mercato.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app_name="mercato-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mercato-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="mercato-test-")
