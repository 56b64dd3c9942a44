from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from scholaudit.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__checkpoint__dir=str(root / "shared"),
        spark__sql__warehouse__dir=str(root / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
