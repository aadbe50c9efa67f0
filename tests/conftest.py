import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from playstream import get_session, checkpoint_dir
    s = get_session("local[*]", app="playstream-tests", shuffle_partitions=8)
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
