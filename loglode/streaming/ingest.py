"""Continuous ingest: a stream of lines into the access-log table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from loglode.model import BLOCK
from loglode.operators.counters import counter_columns
from loglode.operators.sink import replace_batch
from loglode.operators.versions import Versions
from loglode.plans.pipeline import Ingest
from loglode.sources.files import with_place
from loglode.streaming.tiers import Tiers

COUNTER_NAMES = ["lines_read", "parse_errors", "lines_filtered", "lines_processed"]
BATCHES = {
    **dict.fromkeys([*COUNTER_NAMES, "lines_stored"], "bigint"),
    "flush_seconds": "double",
    "batch_id": "bigint",
}
BATCH_SCHEMA = StructType([StructField(name, {"bigint": LongType(), "double": DoubleType()}[kind]) for name, kind in BATCHES.items()])


def cadence(interval_s: float | None) -> dict:
    """Trigger: one batch per interval, or everything at hand once when there is none."""
    if interval_s is None:
        return {"availableNow": True}
    return {"processingTime": f"{interval_s} seconds"}


def batch_tiers(spark: SparkSession, path: str) -> Tiers:
    """The counters of the batches of a table, one row each."""
    return Tiers(spark, f"{path.rstrip('/')}-batches", merge=lambda rows: rows)


def start_ingest(
    lines: DataFrame,
    ingest: Ingest,
    path: str,
    checkpoint: str,
    interval_s: float | None = 5,
) -> StreamingQuery:
    """Run the pipeline on a stream of lines and append its rows to ``path``.

    A restart on the same checkpoint goes on where the last finished batch ended, and a batch that
    is written again replaces itself. Each batch also leaves one row of counters (``batch_log``). The
    work of a batch does not grow with the batches before it: it reads the commits since its last one,
    counts the rows of the files it wrote, and its counters are folded in tiers.
    """
    versions = Versions(lines.sparkSession, path)
    log = batch_tiers(lines.sparkSession, path)
    log.declare(BATCH_SCHEMA)

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        if BLOCK in batch.columns:
            batch = with_place(batch)
        judged = ingest.judged(batch).observe(seen, *counter_columns())
        began = time.monotonic()
        parts = replace_batch(ingest.rows(judged), number, path, versions=versions)
        seconds = time.monotonic() - began
        counted = seen.get
        row = {name: counted[name] for name in COUNTER_NAMES}
        # Counted in the files that were committed, not taken from the plan that wrote them.
        row |= {"lines_stored": sum(part.rows for part in parts), "flush_seconds": seconds, "batch_id": number}
        frame = batch.sparkSession.range(1).select(
            *[F.lit(row[name]).cast(kind).alias(name) for name, kind in BATCHES.items()]
        )
        log.add(frame.coalesce(1), number)

    return (
        lines.writeStream.trigger(**cadence(interval_s))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )


def batch_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch ever written to the table at ``path``: line counters, rows stored, seconds."""
    return batch_tiers(spark, path).frame()
