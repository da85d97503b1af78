import pytest

from sieveline.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 8, "6g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    return session
