from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from compare import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4)
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Frame of text lines."""

    def build(*texts):
        return spark.createDataFrame([(text,) for text in texts], "value string")

    return build
