import os

import pytest

os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import session

    s = session("tests", **{"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
