import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("state")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from loglode.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture
def lines(spark):
    """A function that makes a DataFrame of lines, with a number per line."""

    def build(*values):
        rows = [(i, value) for i, value in enumerate(values)]
        return spark.createDataFrame(rows, "id bigint, value string")

    return build
