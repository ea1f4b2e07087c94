from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for path in (ROOT, ROOT / "tests"):
    if str(path) not in sys.path:
        sys.path.insert(0, str(path))

from tallyforge import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g", spark__ui__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    folder = Path("/root/testdata/sf0.001")
    if not folder.exists():
        pytest.skip("no test tables")
    return str(folder)
