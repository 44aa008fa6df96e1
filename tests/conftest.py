from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from statloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[8]", conf={
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(base / "shared"),
        "spark.sql.warehouse.dir": str(base / "warehouse"),
        "spark.ui.showConsoleProgress": "false",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
