"""Series panels kept up to date while rows arrive.

Every batch leaves partial sums per time bucket; a reader adds them up. So a row counts however
late it comes, and a row with a clock in the future has a bucket of its own and harms no other.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from loglode.functions.text import request_target
from loglode.plans.panels import TOP, bucket, in_range, ranked, top_keys
from loglode.streaming.ingest import cadence
from loglode.streaming.tiers import Tiers

#: Folders of a tier that are folded into one.
FOLD = 8
#: Keys that a sketch of a top list tracks, and those of them that are counted again.
TRACKED, CANDIDATES = 10_000, 1_000
#: Size parameter of the sketches of different values; they are off by about one percent.
DISTINCT = 14
TOP_KEYS = {
    "url": lambda: request_target(F.col("Request")),
    "ip": lambda: F.col("RemoteAddr"),
    "ua": lambda: F.col("HttpUserAgent"),
}
#: Size parameter of the quantile sketches; ranks are off by well under one percent.
SKETCH = 1_000


def live_traffic(rows: DataFrame, interval_s: int) -> DataFrame:
    """Partial sums of latency, errors, bandwidth and rate per bucket of table rows."""
    return rows.groupBy(bucket(interval_s), F.lit(interval_s).alias("interval_s")).agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count("RequestTime").alias("timed"),
        F.sum("RequestTime").alias("seconds"),
        F.kll_sketch_agg_double("RequestTime", SKETCH).alias("sketch"),
        F.count_if(F.col("Status") >= 400).alias("wrong"),
        F.count_if(F.col("Status") >= 500).alias("failed"),
        F.sum("BytesSent").alias("bytes_sent"),
    )


def live_status_classes(rows: DataFrame, interval_s: int) -> DataFrame:
    """Partial counts per bucket and status class of table rows."""
    hundred = F.concat(F.expr("Status div 100").cast("string"), F.lit("xx"))
    return rows.groupBy(bucket(interval_s), hundred.alias("status_class")).agg(
        F.count(F.lit(1)).alias("cnt")
    )


def live_tops(rows: DataFrame, interval_s: int) -> DataFrame:
    """Per bucket the requests, and sketches of the most frequent targets, clients and agents.

    A sketch tracks up to TRACKED keys; a count is off by 2.7 requests in TRACKED at most.
    """
    keys = rows.select("TimeLocal", *[key().alias(name) for name, key in TOP_KEYS.items()])
    sketches = [F.expr(f"approx_top_k_accumulate({name}, {TRACKED})").alias(f"top_{name}") for name in TOP_KEYS]
    return keys.groupBy(bucket(interval_s), F.lit(interval_s).alias("interval_s")).agg(
        F.count(F.lit(1)).alias("cnt"), *sketches
    )


def live_agents(rows: DataFrame, interval_s: int) -> DataFrame:
    """Per bucket the requests with a user agent and those of bots, and sketches of the different agents."""
    agent, bot = F.col("HttpUserAgent"), F.col("IsBot") == 1
    known = F.when(~agent.isin("", "-"), agent)
    return rows.groupBy(bucket(interval_s), F.lit(interval_s).alias("interval_s")).agg(
        F.count(known).alias("lookups"),
        F.count_if(bot).alias("bot_requests"),
        F.hll_sketch_agg(known, DISTINCT).alias("distinct_agents"),
        F.hll_sketch_agg(F.when(bot, agent), DISTINCT).alias("distinct_bots"),
    )


KEYS = ["time", "interval_s", "status_class"]


def added_up(name: str) -> Column:
    """The aggregate that adds up a column of partial sums; its name tells the kind."""
    if name == "sketch":
        return F.kll_merge_agg_double(name, SKETCH).alias(name)
    if name.startswith("top_"):
        return F.expr(f"approx_top_k_combine({name}, {TRACKED})").alias(name)
    if name.startswith("distinct_"):
        return F.hll_union_agg(name).alias(name)
    return F.sum(name).alias(name)


def merged(parts: DataFrame) -> DataFrame:
    """Partial sums added up, one row per bucket."""
    keys = [name for name in KEYS if name in parts.columns]
    return parts.groupBy(*keys).agg(*[added_up(name) for name in parts.columns if name not in keys])


def live_tiers(spark: SparkSession, path: str) -> Tiers:
    return Tiers(spark, path, merge=lambda parts: merged(parts).orderBy("time"), fold=FOLD)


def start_live(
    rows: DataFrame, build, interval_s: int, path: str, checkpoint: str, cadence_s: float | None = 30
) -> StreamingQuery:
    """Write the partial sums that ``build`` makes of each batch of table rows to ``path``.

    A replayed batch replaces itself. Every FOLD batches are added up into one folder, every FOLD of
    those into one again, and so on (``tiers``), in the order of time.
    """
    tiers = live_tiers(rows.sparkSession, path)
    empty = rows.sparkSession.createDataFrame([], rows.schema)
    tiers.declare(build(empty, interval_s).schema)

    def write(batch: DataFrame, number: int) -> None:
        tiers.add(build(batch, interval_s), number)

    return (
        rows.writeStream.trigger(**cadence(cadence_s))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )


def partials(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """All partial sums below ``path`` whose buckets begin from ``start`` to ``end``."""
    parts = live_tiers(spark, path).frame()
    for moment, within in ((start, F.col("time").__ge__), (end, F.col("time").__le__)):
        if moment is not None:
            # Folders are in the order of time, so the scan passes over what lies outside.
            parts = parts.where(within(F.lit(str(moment)).cast("timestamp_ntz")))
    return parts


def current(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """The series as it stands now, of the buckets that begin from ``start`` to ``end``.

    A series without batches yet is empty and has its columns.
    """
    rows = merged(partials(spark, path, start, end))
    if "sketch" not in rows.columns:
        return rows
    total = F.greatest(F.col("cnt"), F.lit(1))
    quantile = lambda share: F.when(
        F.col("timed") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share))
    )
    return rows.select(
        "time",
        "cnt",
        F.try_divide("seconds", "timed").alias("avg"),
        quantile(0.95).alias("p95"),
        quantile(0.99).alias("p99"),
        (F.col("wrong") * F.lit(100.0) / total).alias("error_4xx_5xx"),
        (F.col("failed") * F.lit(100.0) / total).alias("error_5xx"),
        "bytes_sent",
        (F.col("cnt") / F.col("interval_s")).alias("rps"),
    )


def current_top(
    spark: SparkSession, path: str, table: DataFrame, name: str, interval_s: int, start: str, end: str, top: int = TOP
) -> DataFrame:
    """The ``top`` most frequent urls, ips or uas of the range, exactly counted, with ``rank`` and ``sure``.

    The sketches below ``path`` name CANDIDATES keys, and only their rows of the table are counted: no
    shuffle of all keys. ``sure`` tells that no other key can have as many requests as the last one
    listed: what the sketches say of other keys, with their error, is less.
    """
    first = datetime.fromisoformat(start) - timedelta(seconds=interval_s)
    parts = partials(spark, path, first, end)
    # By a key that is the same everywhere: without one, a task that has no rows fails on its sketch.
    sums = parts.groupBy(F.lit(0).alias("all")).agg(F.sum("cnt").alias("cnt"), added_up(f"top_{name}").alias("top"))
    found = sums.select("cnt", F.expr(f"approx_top_k_estimate(top, {CANDIDATES})").alias("keys")).first()
    keys = [(row.item, row["count"]) for row in found["keys"]] if found else []
    chosen = spark.createDataFrame([(key,) for key, _ in keys], f"{name} string")
    rows = in_range(table, start, end).select(TOP_KEYS[name]().alias(name))
    order = [F.desc("cnt"), F.col(name)]
    counted = rows.join(F.broadcast(chosen), name).groupBy(name).agg(F.count(F.lit(1)).alias("cnt"))
    listed = ranked(counted.orderBy(*order).limit(top), *order)
    # Fewer keys than were asked for need not be all there are: a full sketch drops the rare ones.
    others = max([2.7 * found.cnt / TRACKED if found else 0, *[count for _, count in keys[CANDIDATES - 1 :]]])
    return listed.withColumn("sure", F.col("cnt") > others)


def settled_top(
    spark: SparkSession, path: str, table: DataFrame, name: str, interval_s: int, start: str, end: str, top: int = TOP
) -> DataFrame:
    """The ``top`` most frequent urls, ips or uas of the range, whatever the number of keys.

    The list is that of ``current_top`` where it is full and each of its keys is sure. Sketches of many keys
    that are about as frequent cannot tell which come first, and drop those that are rare; then all keys of
    the range are counted in the table, partly before the shuffle. Either way every row of the list is ``sure``.
    """
    listed = current_top(spark, path, table, name, interval_s, start, end, top)
    # No more than the rows of a short report.
    rows = listed.collect()
    if len(rows) == top and all(row.sure for row in rows):
        return spark.createDataFrame(rows, listed.schema)
    every = top_keys(table, start, end, TOP_KEYS[name](), name, top)
    return every.withColumn("sure", F.lit(True))


def current_reuse(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """How often a request repeats a user agent already seen, and what bots did, from sketches alone.

    ``lookups`` and ``bot_requests`` are exact; ``misses`` and ``bot_agents``, the different agents, are
    estimates, so no distinct over all rows is needed.
    """
    parts = partials(spark, path, start, end)
    sums = parts.agg(*[added_up(name) for name in parts.columns if name not in KEYS])
    known = F.least(F.hll_sketch_estimate("distinct_agents"), F.col("lookups"))
    return sums.select("lookups", known.alias("misses"), "bot_requests", F.hll_sketch_estimate("distinct_bots").alias("bot_agents")).select(
        (F.col("lookups") - F.col("misses")).alias("hits"),
        "misses",
        F.try_divide(F.col("lookups") - F.col("misses"), F.col("lookups")).alias("hit_ratio"),
        "bot_requests",
        "bot_agents",
    )
