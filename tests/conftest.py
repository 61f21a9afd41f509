import pytest

from starweave.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
