import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shoplens.session import local_session

    s = local_session(8, shuffle_partitions=8, app_name="shoplens-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_run():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
