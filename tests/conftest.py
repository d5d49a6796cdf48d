import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="ledgerlake-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_shared(tmp_path):
    return str(tmp_path)
