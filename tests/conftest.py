import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session

    session = local_session(4, "ledgerloom-tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def fresh(spark):
    """A function giving unused paths in the shared folder."""
    from ledgerloom.session import fresh_path

    return lambda name="test": fresh_path(spark, name)


@pytest.fixture
def plan():
    """The physical plan of a frame as text."""

    def text(df) -> str:
        return df._jdf.queryExecution().executedPlan().toString()

    return text
