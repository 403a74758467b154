import pytest

from cellspark.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "cellspark-tests", master="local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
