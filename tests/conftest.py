import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from candlewick.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "table")
