import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from riskloom.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tiny_buckets(monkeypatch):
    """Force the bucketed path of the order statistics on small inputs."""
    from riskloom.plans import ordering

    monkeypatch.setattr(ordering, "ROWS_PER_BUCKET", 20)
