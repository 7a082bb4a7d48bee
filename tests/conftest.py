import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from docketry.session import local_session

    return local_session("tests", partitions=4)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
