import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from phenolens.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", shuffle_partitions=8, app="phenolens-tests")
    yield session
    session.stop()


@pytest.fixture()
def tmpdir_fresh():
    """A new scratch folder for each test (never reused, never cleared)."""
    return tempfile.mkdtemp(prefix="phenolens-test-", dir="/tmp")
