import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchpoint.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Apply a column function to values and return the results in order."""
    def run(function, values, kind="string"):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
        return [r["out"] for r in rows.select("n", function(F.col("v")).alias("out")).orderBy("n").collect()]

    return run
