from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ratewise.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        app="ratewise-tests",
        master="local[8]",
        shuffle_partitions=4,
        conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
