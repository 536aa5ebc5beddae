import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from notewright.session import build_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
        spark__driver__bindAddress="127.0.0.1",
        spark__driver__host="127.0.0.1",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_sf():
    folder = TESTDATA / "sf0.001"
    if not folder.exists():
        pytest.skip("test tables are not present")
    return str(folder)
