import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from millrace.session import build_session

    s = build_session(cpus="*", shuffle_partitions=8, app="millrace-tests")
    yield s


SF = "/root/testdata/sf0.001"
