import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from burnlens.session import build_session

    s = build_session(cpus="*", shuffle_partitions=8, app="burnlens-tests")
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
