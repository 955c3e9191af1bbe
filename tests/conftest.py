import pytest

from threadglean.session import get_spark


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", "local[8]", spark__sql__shuffle__partitions=8,
                        spark__ui__enabled="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
