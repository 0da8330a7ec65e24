import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from ledgerspark.session import local_session

    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture
def spread(monkeypatch):
    """Makes every key with more than two joined rows a heavy one, and equal rows many."""
    from ledgerspark.operators import keyed

    monkeypatch.setattr(keyed, "HEAVY_ROWS", 2)
    monkeypatch.setattr(keyed, "EQUAL_ROWS", 2)
