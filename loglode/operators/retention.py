"""Keeping a table to its retention period."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from loglode.model import RETENTION_DAYS
from loglode.operators.versions import Part, Versions
from loglode.sources.folders import Folders


def unexpired(table: DataFrame, as_of: datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows younger than the retention period at ``as_of``."""
    cutoff = as_of - timedelta(days=days)
    rows = table.where(F.col("TimeLocal") > F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz"))
    if "month" in table.columns:
        rows = rows.where(F.col("month") >= cutoff.year * 100 + cutoff.month)
    return rows


def expire(
    spark: SparkSession, path: str, as_of: datetime, days: int = RETENTION_DAYS, grace_s: float = 0
) -> list[int]:
    """Delete the months of the table at ``path`` that lie wholly before the cutoff, in one commit.

    Younger months stay whole. Rows without a time go when the day they were loaded is before the
    cutoff. Returns the deleted months.
    """
    cutoff = as_of - timedelta(days=days)
    limit = cutoff.year * 100 + cutoff.month
    if Folders(spark, path).exists("_spark_metadata"):
        raise ValueError("the log of a file-sink stream lists every file of this table")
    versions = Versions(spark, path)

    def is_old(part: Part) -> bool:
        if part.month is None:
            return bool(part.written) and datetime.fromisoformat(part.written) < cutoff
        return part.month < limit

    gone = versions.commit([], is_old)
    if gone:
        time.sleep(grace_s)
        versions.remove(gone)
    return sorted({part.month for part in gone if part.month is not None})
