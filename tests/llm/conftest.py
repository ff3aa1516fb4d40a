import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(Path(__file__).parent)]

from brute import ROWS, TABLE  # noqa: E402

# Workers find the library where the tests do.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), os.environ.get("PYTHONPATH", "")])

@pytest.fixture(scope="session")
def small(spark):
    """A few awkward documents, with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(ROWS, TABLE).repartition(3)
    extra = ["row", "name", "size", "hash", "nll", "kept", "copies", "seat", "bucket", "words"]
    return frame.select("*", *[F.lit(i).alias(x) for i, x in enumerate(extra)])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], TABLE)
