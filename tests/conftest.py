import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from tidemark.session import build_session  # noqa: E402

DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4",
                            spark__driver__memory="6g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def small():
    return str(DATA / "sf0.01")
