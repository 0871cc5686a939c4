import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    from quire.session import local_session

    return local_session(4, partitions=4)
