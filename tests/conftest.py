from __future__ import annotations

import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE), str(HERE.parent)]

from tillworks.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", master="local[8]", partitions=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
