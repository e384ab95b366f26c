import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session("8", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return "/root/testdata/sf0.001"
