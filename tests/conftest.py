import glob
import os
import sys
import time

import pytest

# Naive datetimes in tests mean local time, in Python as in the session.
os.environ["TZ"] = "America/New_York"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tripmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tripmart-tests",
        **{
            "spark.master": "local[*]",
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not glob.glob(f"{path}/*.parquet"):
        pytest.skip("benchmark tables not available")
    return path


@pytest.fixture
def plan_of():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
