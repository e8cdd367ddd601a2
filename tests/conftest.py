import pytest

from textlens.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(frame, *order):
    """Collected tuples, sorted for comparison."""
    columns = order or frame.columns
    return sorted(tuple(r) for r in frame.select(*columns).collect())
