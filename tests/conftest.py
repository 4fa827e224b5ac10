import pytest

from listmill.session import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    found = session("local[4]", 4, spark__ui__enabled="false", spark__driver__memory="4g", spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}", spark__ui__showConsoleProgress="false")
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
