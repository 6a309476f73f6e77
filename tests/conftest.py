import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlight.session import get_session
    s = get_session("local[*]", shuffle_partitions=8, app_name="ledgerlight-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL
