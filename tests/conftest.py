import pytest

from quire.session import get_session


@pytest.fixture(scope="session")
def spark():
    s = get_session("4", 2, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
