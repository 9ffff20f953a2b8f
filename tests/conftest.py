from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from storelens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", checkpoint_dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """DataFrame from a column list with types and tuples."""

    def build(schema: str, *values: tuple):
        return spark.createDataFrame(list(values), schema)

    return build
