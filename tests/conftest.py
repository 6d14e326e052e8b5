import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from creditloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", app="tests", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                            spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


def table(rows):
    return {tuple(r) for r in rows}
