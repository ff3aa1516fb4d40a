"""Time-ranged reports over the access-log table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from loglode.functions.text import request_method, request_target
from loglode.operators.quantiles import exact_quantiles, sketch_quantiles, value_counts
from loglode.operators.sink import newest, read_table
from loglode.operators.versions import AHEAD

# Yellow and red limits of the single-number panels.
LIMITS = {"error_rate": (1.0, 5.0), "avg_time": (0.5, 1.0), "p95": (1.0, 3.0), "p99": (3.0, 10.0)}
TOP = 10
DETAIL_ROWS = 500
DEFAULT_RANGE = timedelta(hours=24)


def _moment(value) -> datetime:
    return value if isinstance(value, datetime) else datetime.fromisoformat(str(value))


def in_range(table: DataFrame, start=None, end=None) -> DataFrame:
    """Rows with ``start <= TimeLocal <= end``; by default the 24 hours before ``end``.

    The table holds the clocks of the logs, so without ``end`` the newest row sets it, of those that are
    not dated in the future. On a table partitioned by ``month`` the months outside the range are never
    listed or read. Where the table's path is known, ``stored_range`` needs no look at the rows.
    """
    if end is None:
        end = _newest(table) or datetime.now()
    start, end = _ends(start, end)
    rows = table.where(F.col("TimeLocal").between(_literal(start), _literal(end)))
    if "month" in table.columns:
        rows = rows.where(F.col("month").between(_month(start), _month(end)))
    return rows


def stored_range(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """The same rows of the table at a path, whose log tells the newest moment and the files to open."""
    if end is None:
        end = newest(spark, path) or datetime.now()
    start, end = _ends(start, end)
    return in_range(read_table(spark, path, (_month(start), _month(end))), start, end)


def _ends(start, end) -> tuple[datetime, datetime]:
    end = _moment(end)
    return _moment(start) if start is not None else end - DEFAULT_RANGE, end


def _literal(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _month(moment: datetime) -> int:
    return moment.year * 100 + moment.month


def _newest(table: DataFrame) -> datetime | None:
    """The last time in a table that is not in the future; with months, only the last such one is read."""
    limit = datetime.now() + AHEAD
    rows = table.where(F.col("TimeLocal") <= _literal(limit))
    if "month" not in table.columns:
        return rows.agg(F.max("TimeLocal")).first()[0]
    months = table.where(F.col("month") <= _month(limit))
    while (last := months.agg(F.max("month")).first()[0]) is not None:
        found = rows.where(F.col("month") == last).agg(F.max("TimeLocal")).first()[0]
        if found is not None:
            return found
        months = months.where(F.col("month") < last)
    return None


def bucket(interval_s: int) -> Column:
    """Start of the time bucket, counted from the epoch; empty buckets do not appear."""
    return F.window("TimeLocal", f"{interval_s} seconds")["start"].alias("time")


def _share(condition: Column) -> Column:
    return F.count_if(condition) * F.lit(100.0) / F.greatest(F.count(F.lit(1)), F.lit(1))


# Single numbers


def total_requests(table: DataFrame, start, end) -> DataFrame:
    return in_range(table, start, end).agg(F.count(F.lit(1)).alias("total"))


def average_rps(table: DataFrame, start, end) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.min("TimeLocal"), F.max("TimeLocal"))
    return in_range(table, start, end).agg(
        (F.count(F.lit(1)) / F.greatest(seconds, F.lit(1))).alias("rps")
    )


def error_rate(table: DataFrame, start, end) -> DataFrame:
    return in_range(table, start, end).agg(_share(F.col("Status") >= 500).alias("error_rate"))


def mean_response_time(table: DataFrame, start, end) -> DataFrame:
    return in_range(table, start, end).agg(F.avg("RequestTime").alias("avg_time"))


def response_quantile(
    table: DataFrame, start, end, share: float, name: str, method: str = "exact"
) -> DataFrame:
    """One quantile of RequestTime; ``method="sketch"`` for a bounded-size estimate."""
    return _quantiles(in_range(table, start, end), {name: share}, [], method)


def _quantiles(rows: DataFrame, names: dict[str, float], by: list[str], method: str) -> DataFrame:
    if method == "exact":
        return exact_quantiles(value_counts(rows, "RequestTime", by), "RequestTime", names, by)
    if method == "sketch":
        return sketch_quantiles(rows, "RequestTime", names, by)
    raise ValueError(f"method must be exact or sketch, not {method!r}")


def level(number: DataFrame, name: str) -> DataFrame:
    """Add ``level``: green, yellow or red by the limits of that number."""
    yellow, red = LIMITS[name]
    value = F.col(name)
    return number.withColumn(
        "level", F.when(value >= red, "red").when(value >= yellow, "yellow").otherwise("green")
    )


# Series


def status_class_series(table: DataFrame, start, end, interval_s: int) -> DataFrame:
    """Requests per bucket and hundred of the status; unlike ``_status_class`` it is unbounded."""
    hundred = F.expr("Status div 100").cast("string")
    return (
        in_range(table, start, end)
        .groupBy(bucket(interval_s), F.concat(hundred, F.lit("xx")).alias("status_class"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy("time", "status_class")
    )


def latency_series(
    table: DataFrame, start, end, interval_s: int, method: str = "exact"
) -> DataFrame:
    """Mean, p95 and p99 of RequestTime per bucket."""
    rows = in_range(table, start, end).select(bucket(interval_s), "RequestTime")
    names = {"p95": 0.95, "p99": 0.99}
    if method == "sketch":
        quantiles = [F.percentile_approx("RequestTime", p, 10_000).alias(n) for n, p in names.items()]
        return rows.groupBy("time").agg(F.avg("RequestTime").alias("avg"), *quantiles).orderBy("time")
    counts = value_counts(rows, "RequestTime", ["time"])
    weight = F.when(F.col("RequestTime").isNotNull(), F.col("n"))
    means = counts.groupBy("time").agg(
        (F.sum(F.col("RequestTime") * F.col("n")) / F.sum(weight)).alias("avg")
    )
    quantiles = exact_quantiles(counts, "RequestTime", names, ["time"])
    quantiles = quantiles.withColumnRenamed("time", "_time")
    # A null-safe match adds no filter to one side only, so both sides share one scan.
    joined = means.join(quantiles, F.col("time").eqNullSafe(F.col("_time")), "left")
    return joined.drop("_time").orderBy("time")


def error_rate_series(table: DataFrame, start, end, interval_s: int) -> DataFrame:
    return (
        in_range(table, start, end)
        .groupBy(bucket(interval_s))
        .agg(
            _share(F.col("Status") >= 400).alias("error_4xx_5xx"),
            _share(F.col("Status") >= 500).alias("error_5xx"),
        )
        .orderBy("time")
    )


def bandwidth_series(table: DataFrame, start, end, interval_s: int) -> DataFrame:
    return (
        in_range(table, start, end)
        .groupBy(bucket(interval_s))
        .agg(F.sum("BytesSent").alias("bytes_sent"))
        .orderBy("time")
    )


def rps_series(table: DataFrame, start, end, interval_s: int) -> DataFrame:
    return (
        in_range(table, start, end)
        .groupBy(bucket(interval_s))
        .agg((F.count(F.lit(1)) / F.lit(interval_s)).alias("rps"))
        .orderBy("time")
    )


def roll_up(series: DataFrame, values: list[str], calcs: list[str], by: str | None = None) -> DataFrame:
    """Legend of a series panel: one row per line with its ``sum``, ``mean`` or ``max``.

    Lines are the value columns, or the values of ``by`` when the panel has one value column.
    """
    calc = {"sum": F.sum, "mean": F.avg, "max": F.max}
    if by:
        points = series.select(F.col(by).alias("series"), F.col(values[0]).alias("point"))
    else:
        points = series.select(*[F.col(v).cast("double").alias(v) for v in values]).unpivot(
            [], values, "series", "point"
        )
    return points.groupBy("series").agg(*[calc[name]("point").alias(name) for name in calcs])


# Breakdowns


def _counted(table: DataFrame, start, end, key: Column) -> DataFrame:
    return in_range(table, start, end).groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))


def by_method(table: DataFrame, start, end) -> DataFrame:
    counted = _counted(table, start, end, request_method(F.col("Request")).alias("method"))
    return counted.orderBy(F.desc("cnt"), "method")


def method_share(table: DataFrame, start, end) -> DataFrame:
    """Requests per method and their share of all requests in percent."""
    counted = _counted(table, start, end, request_method(F.col("Request")).alias("method"))
    total = counted.agg(F.sum("cnt")).scalar()
    return counted.select(
        "method", "cnt", (F.col("cnt") * F.lit(100.0) / total).alias("percent")
    ).orderBy(F.desc("cnt"), "method")


def top_keys(table: DataFrame, start, end, key: Column, name: str, top: int) -> DataFrame:
    # Equal counts are settled by the key, so the report does not vary between runs.
    order = [F.desc("cnt"), F.col(name)]
    return ranked(_counted(table, start, end, key.alias(name)).orderBy(*order).limit(top), *order)


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """Add ``rank``, the place of each row of a short report in its order."""
    return rows.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def top_urls(table: DataFrame, start, end, top: int = TOP) -> DataFrame:
    return top_keys(table, start, end, request_target(F.col("Request")), "url", top)


def top_clients(table: DataFrame, start, end, top: int = TOP) -> DataFrame:
    return top_keys(table, start, end, F.col("RemoteAddr"), "ip", top)


def top_agents(table: DataFrame, start, end, top: int = TOP) -> DataFrame:
    return top_keys(table, start, end, F.col("HttpUserAgent"), "ua", top)


def slow_or_failed(table: DataFrame, start, end, rows: int = DETAIL_ROWS) -> DataFrame:
    """The newest requests that failed or took more than a second."""
    found = in_range(table, start, end).where((F.col("Status") >= 400) | (F.col("RequestTime") > 1))
    detail = found.select(
        "TimeLocal", "RemoteAddr",
        request_method(F.col("Request")).alias("Method"),
        request_target(F.col("Request")).alias("URL"),
        "Status", "BytesSent", "RequestTime", "HttpReferer", "HttpUserAgent",
    )
    order = [F.desc("TimeLocal"), *[F.col(name) for name in detail.columns if name != "TimeLocal"]]
    return ranked(detail.orderBy(*order).limit(rows), *order)


def slowest_first(table: DataFrame, start, end, rows: int = DETAIL_ROWS) -> DataFrame:
    """The same requests, sorted by response time."""
    detail = slow_or_failed(table, start, end, rows)
    return ranked(detail, F.desc("RequestTime"), F.col("rank")).orderBy("rank")
