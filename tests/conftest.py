import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DATA = os.environ.get("TEST_DATA", "/root/testdata")
SF = os.environ.get("TEST_SF", "0.001")


@pytest.fixture(scope="session")
def spark():
    from flowlens.session import local_session

    return local_session("8", shuffle_partitions=4, memory="6g", scratch=tempfile.mkdtemp(prefix="flowlens-"))


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf{SF}"
