import pytest

from tillwright.session import local_session, tune


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    return tune(session)
