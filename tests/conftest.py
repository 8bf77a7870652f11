import pytest

from runloom.session import clean, get_session


@pytest.fixture(scope="session")
def spark():
    session = get_session(4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clean(session)
