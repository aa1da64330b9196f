import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from meterlane.session import build_session

    session = build_session("tests", master="local[8]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
