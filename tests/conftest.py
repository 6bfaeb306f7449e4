import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from slotfuse import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "slotfuse-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, NULLs first."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        key = lambda row: tuple((v is not None, str(type(v)), v) for v in row)
        return sorted((tuple(r) for r in df.collect()), key=key)

    return collect
