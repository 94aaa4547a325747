import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]


@pytest.fixture(scope="session")
def spark():
    from provfin.functions.session import local_session

    session = local_session(cores="8", memory="6g", partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("PROVFIN_SF_DIR", "/root/testdata/sf0.001")
