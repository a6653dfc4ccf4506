import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from churnspark.session import local_session
    s = local_session("*", shuffle_partitions=8, app="churnspark-tests")
    yield s


@pytest.fixture(scope="session")
def sf001():
    return "/root/testdata/sf0.001"
