import pytest

from tests.oracle import connect
from vectrail.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "vectrail-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF


@pytest.fixture(scope="session")
def duck():
    return connect(SF)
