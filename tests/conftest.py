import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from corpusforge import get_session
    return get_session("local[4]", 4)


@pytest.fixture(scope="session")
def sf_dir():
    return SF001
