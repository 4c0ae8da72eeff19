import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from isobar.session import get_session, shared_dir

    s = get_session("local[4]", app="isobar-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    shared_dir(s)  # a local checkpoint folder only when none is configured
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    """A fresh scratch folder per test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="isobar-test-")
