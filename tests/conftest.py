import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mnemolake.runtime import local_session

    s = local_session(4, 4)
    s.sparkContext.setLogLevel("OFF")
    return s


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return SMALL
