import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quillstat.session import local_session

    s = local_session(4, shuffle_partitions=4, app="quillstat-tests")
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="qs-test-", dir=os.environ.get("TMPDIR", "/tmp"))
