import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from parcelspark.session import get_session
    s = get_session(master="local[*]", shuffle_partitions=8, shared=tempfile.mkdtemp(prefix="parcelspark-shared-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="parcelspark-test-", dir="/tmp")
