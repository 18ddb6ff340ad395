import pytest

from citeloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("4", 4, "4g")
