import pytest

from tallyhouse.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", shuffle_partitions=8, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
