import pytest

from casewright.session import clear_scratch, local_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", memory="8g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return DATA
