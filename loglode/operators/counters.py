"""What an ingest run did, as numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Upper bounds of the batch-size and flush-duration histograms.
BATCH_SIZES = [10, 50, 100, 500, 1000, 5000, 10000]
FLUSH_SECONDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10]


def counter_columns() -> list[Column]:
    """Aggregates over lines that carry ``_error`` and ``_kept``."""
    good = F.col("_error").isNull()
    kept = F.coalesce(F.col("_kept"), F.lit(True))
    return [
        F.count(F.lit(1)).alias("lines_read"),
        F.count_if(~good).alias("parse_errors"),
        F.count_if(good & ~kept).alias("lines_filtered"),
        F.count_if(good & kept).alias("lines_processed"),
    ]


def line_counters(batches: DataFrame) -> DataFrame:
    """Sums over the batches of a run: what was read, failed, filtered, processed and not stored.

    ``lines_processed`` were meant for the table; ``lines_not_processed`` of them are not in it.
    """
    names = ["lines_read", "parse_errors", "lines_filtered"]
    stored, meant = F.sum("lines_stored"), F.sum("lines_processed")
    return batches.agg(
        *[F.sum(name).alias(name) for name in names],
        stored.alias("lines_processed"),
        (meant - stored).alias("lines_not_processed"),
    )


def reconciled(batches: DataFrame, table: DataFrame) -> DataFrame:
    """lines_read, rows_stored and balanced: whether every good and kept line is in the table now.

    Two sources are compared: the counters of the batches and the rows that the table holds.
    """
    rows = table.where(F.col("batch_id") >= 0).agg(F.count(F.lit(1)).alias("rows_stored"))
    left_out = F.col("parse_errors") + F.col("lines_filtered")
    sums = batches.agg(
        *[F.sum(name).alias(name) for name in ("lines_read", "parse_errors", "lines_filtered")]
    )
    # Two single rows.
    return sums.join(rows).select(
        "lines_read", "rows_stored", (F.col("lines_read") == left_out + F.col("rows_stored")).alias("balanced")
    )


def histogram(batches: DataFrame, value: str, bounds: list[float]) -> DataFrame:
    """Cumulative histogram: one row per upper bound with ``observations`` up to it.

    The last row, without a bound, counts everything.
    """
    tops = [*bounds, None]
    counts = batches.agg(
        F.array(
            *[
                F.count_if(F.col(value) <= top) if top is not None else F.count(value)
                for top in tops
            ]
        ).alias("counts")
    )
    labels = F.array(*[F.lit(top).cast("double") for top in tops])
    zipped = F.inline(F.arrays_zip(labels.alias("le"), F.col("counts").alias("observations")))
    return counts.select(zipped)


def bot_counters(table: DataFrame) -> DataFrame:
    """Requests by bots, and distinct user agents among them."""
    bot = F.col("IsBot") == 1
    return table.agg(
        F.count_if(bot).alias("bot_requests"),
        F.count_distinct(F.when(bot, F.col("HttpUserAgent"))).alias("bot_agents"),
    )


def agent_reuse(table: DataFrame, exact: bool = True) -> DataFrame:
    """How often a request repeats a user agent already seen: hits, misses and hit ratio."""
    known = F.when(~F.col("HttpUserAgent").isin("", "-"), F.col("HttpUserAgent"))
    distinct = F.count_distinct(known) if exact else F.approx_count_distinct(known)
    return table.agg(F.count(known).alias("lookups"), distinct.alias("misses")).select(
        (F.col("lookups") - F.col("misses")).alias("hits"),
        "misses",
        F.try_divide(F.col("lookups") - F.col("misses"), F.col("lookups")).alias("hit_ratio"),
    )
