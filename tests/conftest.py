from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests"), str(ROOT / "tests" / "llm")]


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import local_session

    session = local_session(cores=8, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a DataFrame from tuples and a DDL schema."""

    def build(schema: str, *values: tuple):
        return spark.createDataFrame(list(values), schema)

    return build
