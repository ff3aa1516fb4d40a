"""Writing the access-log table.

The table is plain Parquet in folders ``month=202401/batch_id=7``. Streams write numbered batches,
bulk appends go to batch -1, and any of them may be read, replaced or expired beside the others.
Every change is one commit of the table's log (``versions``). ``read_table`` follows the log and sees
each change whole or not at all; a plain ``spark.read.parquet`` sees the same once a change is over.
"""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loglode.operators.versions import Conflict, Part, Versions, read_parts
from loglode.sources.folders import Folders

SORT_KEY = ["Status", "TimeLocal"]
#: The batch of rows that no stream wrote.
BULK = -1


def with_date(rows: DataFrame) -> DataFrame:
    """Add ``Date``, the day of TimeLocal, when the input does not bring its own."""
    if "Date" in rows.columns:
        return rows
    return rows.withColumn("Date", F.to_date("TimeLocal"))


def month_of(time: Column) -> Column:
    """202401 for any moment of January 2024."""
    return (F.year(time) * 100 + F.month(time)).alias("month")


def laid_out(rows: DataFrame) -> DataFrame:
    """Rows with ``Date`` and ``month``, ordered by month, Status and TimeLocal within each task.

    No shuffle: every task writes one sorted file per month.
    """
    out = with_date(rows).withColumn("month", month_of(F.col("TimeLocal")))
    return out.sortWithinPartitions(*_key(out))


def _key(rows: DataFrame) -> list[str]:
    return ["month", *[name for name in SORT_KEY if name in rows.columns]]


def append(rows: DataFrame, path: str) -> list[Part]:
    """Add rows to the Parquet table at ``path``, partitioned by month, in one commit.

    Rows without a readable time go to the default partition. No rows, no commit.
    """
    if Folders(rows.sparkSession, path).exists("_spark_metadata"):
        # Readers would follow the log that Spark's own file sink keeps there, and miss the rows.
        raise ValueError(f"{path} belongs to a file-sink stream; append to a table of this library")
    versions = Versions(rows.sparkSession, path)
    parts = versions.write(_numbered(laid_out(rows), BULK))
    versions.commit(parts)
    return parts


def _numbered(rows: DataFrame, batch_id: int) -> DataFrame:
    return rows.withColumn("batch_id", F.lit(batch_id))


def read_table(
    spark: SparkSession, path: str, months: tuple[int, int] | None = None, tries: int = 5
) -> DataFrame:
    """The table as of its newest commit; with ``months`` only the parts from the first to the last.

    Files are taken by name, so what a later commit does cannot change what this reads. Where it has
    deleted one already, before the read began, the next state is taken.
    """
    versions = Versions(spark, path)
    for left in reversed(range(tries)):
        parts = list(versions.state().parts.values())
        if not parts:
            raise FileNotFoundError(f"no table at {path}")
        wanted = [p for p in parts if months is None or p.month and months[0] <= p.month <= months[1]]
        try:
            # Of a range without any part, the schema alone.
            return read_parts(spark, path, wanted) if wanted else read_parts(spark, path, parts[:1]).limit(0)
        except Exception as problem:
            if not left or "PATH_NOT_FOUND" not in str(problem):
                raise
            time.sleep(0.1)


def newest(spark: SparkSession, path: str) -> datetime | None:
    """The last time in the table that was not in its writer's future, from the log alone."""
    known = [part.newest for part in Versions(spark, path).state().parts.values() if part.newest]
    return datetime.fromisoformat(max(known)) if known else None


def append_table(rows: DataFrame, table: str) -> None:
    """Add rows to a catalog table by column name."""
    names = rows.sparkSession.table(table).columns
    rows.select(*names).write.insertInto(table)


def append_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Add rows to an outside store; the caller supplies its driver."""
    rows.write.jdbc(url, table, mode="append", properties=properties)


def replace_batch(
    rows: DataFrame, batch_id: int, path: str, grace_s: float = 0, versions: Versions | None = None
) -> list[Part]:
    """Write one micro-batch so that a replay replaces it instead of adding to it; gives its parts.

    One commit adds the new rows and takes what an earlier attempt committed, in every month. Files that
    an attempt left without a commit go first, and an attempt that still runs, as of a stopped stream, ends in
    ``Conflict``: the last one to begin counts. Those that were replaced go
    ``grace_s`` seconds after the commit, for readers that began before it. ``versions`` is the table's log
    as a caller with many batches keeps it, so that each reads only what is new.
    """
    versions = versions or Versions(rows.sparkSession, path)
    claim = versions.claim(batch_id)
    versions.remove(versions.strays(batch_id))
    parts = versions.write(_numbered(laid_out(rows), batch_id))
    try:
        gone = versions.commit(
            parts, lambda part: part.batch == batch_id, allowed=lambda: versions.holds(batch_id, claim)
        )
    except Conflict:
        versions.remove(parts)
        raise
    versions.folders.remove(f"_claims/{batch_id}")
    _settle(versions, gone, grace_s)
    return parts


def _settle(versions: Versions, gone: list[Part], grace_s: float) -> None:
    if gone:
        time.sleep(grace_s)
        versions.remove(gone)


def lay_out_month(rows: DataFrame, path: str, month: int, partitions: int, grace_s: float = 0) -> None:
    """Rewrite one stored month in ``partitions`` even files, each a run of the sort key.

    Reads stored rows, so nothing is parsed again, and folds the small files of many batches into
    one bulk batch. The key ends in a hash of the row, so a crowded second still splits. ``rows`` is the
    table as read. One commit puts the new files in the place of those that were read; a crash before it
    leaves the month as it was, and where a stream has replaced one of them meanwhile ``Conflict`` is
    raised. Rows that come while this runs stay as they are.
    """
    versions = Versions(rows.sparkSession, path)
    old = [part for part in versions.state().parts.values() if part.month == month]
    if not old:
        return
    stored = read_parts(rows.sparkSession, path, old).drop("batch_id")
    spread = F.xxhash64(*[F.col(name) for name in stored.columns])
    ranged = stored.repartitionByRange(partitions, *_key(stored), spread).sortWithinPartitions(*_key(stored))
    parts = versions.write(_numbered(ranged, BULK))
    try:
        gone = versions.commit(parts, needs={part.key for part in old})
    except Exception:
        versions.remove(parts)
        raise
    _settle(versions, gone, grace_s)


def clean(spark: SparkSession, path: str) -> list[str]:
    """Delete what crashed writers left without a commit. No writer may be at work."""
    versions = Versions(spark, path)
    strays = versions.strays()
    versions.remove(strays)
    versions.folders.remove("_writing")
    return sorted(f"{part.folder}/{name}" for part in strays for name in part.files)
