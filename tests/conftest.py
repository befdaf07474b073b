import pytest

from shelfwise.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", 4, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                                                "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
