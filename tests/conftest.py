import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

SF = os.environ.get("TIDEBOOK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidebook.session import build_session

    s = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.ui.showConsoleProgress": "false",
    })
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF
