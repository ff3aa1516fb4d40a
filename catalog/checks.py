"""One query per operator, each over the whole of its input tables."""

from __future__ import annotations

import glob
import os
import shutil
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from catalog.fixture import LINE_FIELDS, LINE_FORMAT, events, json_lines, text_lines
from loglode.functions.text import status_class
from loglode.functions.urls import request_extension, url_host
from loglode.model import BASIC_COLUMNS, FULL_COLUMNS
from loglode.operators import counters, retention, sink
from loglode.operators.columns import Tags, map_columns
from loglode.operators.contract import check_table
from loglode.operators.parse import parse_text, split_valid
from loglode.operators.parse_json import parse_json
from loglode.operators.quantiles import exact_quantiles, value_counts
from loglode.operators.rules import Rule, apply_rules, check_rules, sampled
from loglode.operators.typed import cast_fields
from loglode.operators.versions import Versions
from loglode.plans import panels
from loglode.plans.pipeline import Ingest
from loglode.session import configure, fresh_dir
from loglode.sources.files import normalise, read_logs, stream_logs
from loglode.sources.tail import TailSource
from loglode.streaming.ingest import batch_log, start_ingest
from loglode.streaming.live import (
    current,
    current_reuse,
    live_agents,
    live_status_classes,
    live_tiers,
    live_tops,
    live_traffic,
    settled_top,
    start_live,
)

Query = Callable[[SparkSession, str], DataFrame]

START, END = "2024-01-01 00:00:00", "2024-01-31 23:59:59"
HOUR = 3600
TABLE_COLUMNS = {**BASIC_COLUMNS, "RequestTime": "request_time"}
TAGS = Tags("web-02", "production", "api-gateway", {"my_tag": "us-east-1"})
RULE_FIELDS = [*LINE_FIELDS, "upstream_response_time"]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        return build

    return register


# Inputs


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(events(spark, sf_dir))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good lines with their text fields and ``event_id``."""
    return split_valid(parse_text(lines(spark, sf_dir), LINE_FORMAT))[0]


def table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return map_columns(parsed(spark, sf_dir), TABLE_COLUMNS)


def agent_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"HttpUserAgent": "http_user_agent", "IsBot": "_is_bot"}
    return map_columns(parsed(spark, sf_dir), columns)


def stored_lines(spark: SparkSession, rows: DataFrame, path: str | None = None) -> str:
    """Lines written as text files, for the queries that read files."""
    path = path or fresh_dir(spark, "lines")
    rows.select("value").write.mode("append").text(path)
    return path


def in_two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines of the first half of the month, and the rest."""
    source = events(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return text_lines(source.where(early)), text_lines(source.where(~early))


def rounded(rows: DataFrame, *names: str, digits: int = 10) -> DataFrame:
    """Doubles cut to where the order of a sum no longer shows."""
    return rows.withColumns({name: F.round(name, digits) for name in names})


# A: sources


@query("a1_read_logs")
def _(spark, sf_dir):
    return read_logs(spark, stored_lines(spark, lines(spark, sf_dir))).select("value")


def _drain(stream: DataFrame, spark: SparkSession, path: str, checkpoint: str) -> None:
    (
        stream.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        .awaitTermination()
    )


@query("a2_stream_logs")
def _(spark, sf_dir):
    logs = stored_lines(spark, lines(spark, sf_dir))
    out = fresh_dir(spark, "streamed")
    _drain(stream_logs(spark, logs, max_files_per_trigger=100), spark, out, out + "-state")
    return spark.read.parquet(out).select("value")


def _tail(spark: SparkSession, logs: str, start: str) -> DataFrame:
    spark.dataSource.register(TailSource)
    reader = spark.readStream.format("log_tail").option("startingOffsets", start)
    return reader.load(logs)


@query("a3_tail")
def _(spark, sf_dir):
    # One file that is read, added to, rotated and begun anew, in three parts.
    source = events(spark, sf_dir)
    base, out = fresh_dir(spark, "log"), fresh_dir(spark, "tailed")
    log = f"{base.removeprefix('file:')}/access.log"
    os.makedirs(os.path.dirname(log))
    for step in range(3):
        rows = text_lines(source.where(F.col("event_id") % 3 == step))
        part = stored_lines(spark, rows)
        if step == 2:
            os.rename(log, log + "-20240131")
        with open(log, "ab") as whole:
            for name in sorted(glob.glob(f"{part.removeprefix('file:')}/part-*")):
                with open(name, "rb") as piece:
                    shutil.copyfileobj(piece, whole)
        if step != 1:  # what is added before the rotation is read after it
            _drain(_tail(spark, log, "earliest"), spark, out, out + "-state")
    return spark.read.parquet(out).select("value")


@query("a4_start_position")
def _(spark, sf_dir):
    early, rest = in_two(spark, sf_dir)
    logs, out = fresh_dir(spark, "lines"), fresh_dir(spark, "tailed")
    for part in (early, rest):
        stored_lines(spark, part, logs)
        _drain(_tail(spark, f"{logs.removeprefix('file:')}/part-*.txt", "latest"), spark, out, out + "-state")
    return spark.read.parquet(out).select("value")


@query("a5_normalise")
def _(spark, sf_dir):
    # Some lines are longer than a megabyte.
    long = F.when(F.col("event_id") % 5000 == 1, F.repeat(F.lit("y"), 1_100_000)).otherwise("")
    padded = lines(spark, sf_dir).withColumn(
        "value", F.concat(F.lit(" \t"), "value", long, F.lit(" \v\r"))
    )
    return normalise(padded)


# B: parsing


@query("b1_long_lines")
def _(spark, sf_dir):
    """Lines longer than a megabyte are lines like others."""
    longer = F.when(F.col("event_id") % 1000 == 3, F.repeat(F.lit("a"), 1_200_000)).otherwise("")
    rows = lines(spark, sf_dir).withColumn("value", F.regexp_replace("value", "^10", F.concat(longer, F.lit("10"))))
    good = split_valid(parse_text(rows, LINE_FORMAT))[0]
    return good.select("event_id", F.length("remote_addr").alias("size"), "request_time")


@query("b1_parse_text")
def _(spark, sf_dir):
    return parsed(spark, sf_dir).drop("value")


@query("b2_parse_json")
def _(spark, sf_dir):
    rows = parse_json(json_lines(events(spark, sf_dir)), LINE_FIELDS)
    return split_valid(rows)[0].drop("value")


@query("b3_json_scalars")
def _(spark, sf_dir):
    k = F.regexp_extract("props", "([0-9]+)", 1)
    forms = {
        "i": k, "z": F.concat(k, F.lit(".0")), "f": F.concat(k, F.lit(".50")),
        "e": F.concat(k, F.lit("e2")), "m": F.concat(k, F.lit("e-7")),
        "x": F.concat(k, F.lit("e20")), "b": (F.col("event_id") % 2 == 0).cast("string"),
        "n": F.lit("null"), "s": F.concat(F.lit('"'), k, F.lit('.00"')),
        "o": F.concat(F.lit('{"y":'), k, F.lit(',"a":"<&"}')),
    }
    members = [part for name, text in forms.items() for part in (F.lit(f',"{name}":'), text)]
    source = events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), *members, F.lit("}"))
        .alias("value"),
    )
    rows = parse_json(source, [*forms, "absent"])
    return rows.drop("value", "_error")


@query("b4_parse_errors")
def _(spark, sf_dir):
    bad = split_valid(parse_text(lines(spark, sf_dir), LINE_FORMAT))[1]
    return bad.withColumnRenamed("_error", "error")


@query("b5_typed_fields")
def _(spark, sf_dir):
    event = F.col("event_id")
    rows = parsed(spark, sf_dir).withColumns(
        {
            "status": F.when(event % 50 == 0, "OK").otherwise(F.col("status")),
            "bytes_sent": F.when(event % 60 == 0, " 7").otherwise(F.col("bytes_sent")),
            "time_local": F.when(event % 70 == 0, "yesterday").otherwise(F.col("time_local")),
            "request_time": F.when(event % 80 == 0, "1.0d").otherwise(F.col("request_time")),
        }
    )
    cast = cast_fields(rows.drop("value"), LINE_FIELDS)
    return rounded(cast, "request_time").select(
        "event_id", "time_local", "status", "bytes_sent", "request_time", "remote_addr",
        F.array_join("_bad_fields", ",").alias("bad_fields"),
    )


@query("b6_blank_lines")
def _(spark, sf_dir):
    blanked = lines(spark, sf_dir).withColumn(
        "value", F.when(F.col("event_id") % 10 == 0, " ").otherwise(F.col("value"))
    )
    rows = parse_text(normalise(blanked), LINE_FORMAT)
    return rows.groupBy((F.col("value") == "").alias("blank"), F.col("_error").alias("error")).agg(
        F.count(F.lit(1)).alias("cnt")
    )


# C: columns and enrichment


@query("c01_map_columns")
def _(spark, sf_dir):
    return rounded(table(spark, sf_dir), "RequestTime")


@query("c02_missing_field")
def _(spark, sf_dir):
    columns = {"Status": "status", "Server": "server_name", "Connection": "connection"}
    rows = map_columns(parsed(spark, sf_dir), columns, keep=("event_id",), bad=True)
    return rows.withColumn("bad_fields", F.array_join("_bad_fields", ",")).drop("_bad_fields")


def _derived(name: str, source: str) -> None:
    @query(name)
    def _(spark, sf_dir):
        return map_columns(parsed(spark, sf_dir), {"value": source}, TAGS, keep=("event_id",))


for _name, _source in {
    "c03_hostname": "_hostname",
    "c04_environment": "_environment",
    "c05_service": "_service",
    "c06_extra": "_extra.my_tag",
    "c06_extra_missing": "_extra.nonexistent",
    "c07_status_class": "_status_class",
    "c08_referrer_domain": "_referrer_domain",
    "c09_url_extension": "_url_extension",
    "c10_is_bot": "_is_bot",
    "c11_bot_name": "_bot_name",
    "c12_bot_class": "_bot_class",
    "c13_browser": "_browser",
    "c14_browser_version": "_browser_version",
    "c15_os": "_os",
    "c16_device_type": "_device_type",
    "c17_unknown_source": "_no_such_source",
}.items():
    _derived(_name, _source)


@query("c07_status_class_raw")
def _(spark, sf_dir):
    # Any text may stand where a status should; only a leading 1 to 5 makes a class.
    odd = F.concat(F.regexp_extract("props", "([0-9]+)", 1), F.lit("x"))
    return events(spark, sf_dir).select("event_id", status_class(odd).alias("value"))


@query("c08_page_host")
def _(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", url_host(F.col("url")).alias("host"))


@query("c09_page_extension")
def _(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = F.regexp_extract("url", "^https?://[^/]+(.*)$", 1)
    request = F.concat(F.lit("GET "), path, F.lit(" HTTP/1.1"))
    return pages.select("page_id", request_extension(request).alias("extension"))


@query("c03_hostname_by_file")
def _(spark, sf_dir):
    """Logs of several hosts in one read; each row has the host of its file."""
    logs = fresh_dir(spark, "lines")
    source = lines(spark, sf_dir).withColumn("host", F.concat(F.lit("web-"), F.col("event_id") % 3))
    source.select("host", "value").write.partitionBy("host").text(logs)
    tags = Tags("other", host_pattern="/host=([^/]+)/")
    job = Ingest(LINE_FORMAT, {"Request": "request", "Hostname": "_hostname"}, tags=tags)
    return job.run(read_logs(spark, f"{logs}/*"))


def _full_row(name: str, make, log_format: str | None) -> None:
    @query(name)
    def _(spark, sf_dir):
        job = Ingest(log_format, FULL_COLUMNS, tags=TAGS)
        return rounded(job.run(make(events(spark, sf_dir))), "RequestTime")


_full_row("c18_full_row", text_lines, LINE_FORMAT)
_full_row("c18_full_row_json", json_lines, None)


# D: rules


def _ruled(name: str, *rules: Rule, change=None) -> None:
    @query(name)
    def _(spark, sf_dir):
        rows = parsed(spark, sf_dir)
        if change:
            rows = change(rows)
        kept = apply_rules(rows, list(rules), RULE_FIELDS, key="event_id")
        return kept.select("event_id", "status", "request")


_ruled("d01_drop", Rule("status >= 200 and status < 300", "drop"))
_ruled("d02_keep", Rule("status >= 500", "keep"))
_ruled("d03_sampled_drop", Rule("status < 400", "drop", 0.9))
_ruled("d04_sampled_keep", Rule("status < 400", "keep", 0.25))
_ruled("d06_ordered_chain", Rule("status >= 404", "keep"), Rule("contains(request, 'POST')", "drop"),
       Rule("request_time > 0.2", "drop"))
_ruled(
    "d07_numeric_coercion",
    Rule("status = 0 or bytes_sent = 0", "keep"),
    Rule("upstream_response_time > 1", "drop"),
    change=lambda rows: rows.withColumn(
        "status", F.when(F.col("event_id") % 7 == 0, "abc").otherwise(F.col("status"))
    ),
)
_ruled("d08_predicates", Rule("not request rlike '^GET /health' and contains(request, '.html') "
                              "or http_user_agent = 'curl/7.68.0'", "keep"))
_ruled("d10_fail_open", Rule("bytes_sent / (status - 200) > 10", "keep"))


@query("d05_sampler")
def _(spark, sf_dir):
    return events(spark, sf_dir).where(sampled(0.3, F.col("event_id"), "|salt")).select("event_id")


@query("d05_streamed_twice")
def _(spark, sf_dir):
    """Two streams over the same files sample the same rows: none is in one table only."""
    logs = stored_lines(spark, lines(spark, sf_dir))
    job = Ingest(LINE_FORMAT, TABLE_COLUMNS, (Rule("status < 400", "drop", 0.5),))
    tables = []
    for _ in range(2):
        out = fresh_dir(spark, "table")
        start_ingest(stream_logs(spark, logs, 3), job, out, out + "-state", None).awaitTermination()
        tables.append(spark.read.parquet(out).drop("batch_id"))
    one, other = tables
    differ = one.exceptAll(other).unionAll(other.exceptAll(one))
    counts = one.agg(F.count(F.lit(1)).alias("kept"), F.count_if(F.col("Status") >= 400).alias("errors"))
    return counts.join(differ.agg(F.count(F.lit(1)).alias("in_one_only"))).select(
        F.col("kept").between(F.col("errors") + 1, F.lit(2**40)).alias("sampled"), "errors", "in_one_only"
    )


@query("d05_equal_lines")
def _(spark, sf_dir):
    """One file that holds the same line for every event, sampled without a key, twice and by three ways.

    A fair share is kept each time, and the second run keeps what the first kept.
    """
    spark.dataSource.register(TailSource)
    line = '10.0.0.1 - - [01/Jan/2024:00:00:00 -0700] "GET /same HTTP/1.1" 200 1 "-" "-" 0.001'
    logs = stored_lines(spark, events(spark, sf_dir).coalesce(1).select(F.lit(line).alias("value")))
    total = spark.read.text(logs).count()
    kept = Ingest(LINE_FORMAT, TABLE_COLUMNS, (Rule("status = 200", "keep", 0.5),))
    left = Ingest(LINE_FORMAT, TABLE_COLUMNS, (Rule("status = 200", "drop", 0.5),))

    def places(job: Ingest) -> DataFrame:
        return job.judged(read_logs(spark, logs)).where("_kept").select("_file", "_at")

    def streamed(lines: DataFrame, job: Ingest) -> int:
        out = fresh_dir(spark, "table")
        start_ingest(lines, job, out, out + "-state", None).awaitTermination()
        return spark.read.parquet(out).count()

    def tailed() -> DataFrame:
        return _tail(spark, logs.removeprefix("file:") + "/*.txt", "earliest")

    found = []
    for name, job in (("keep", kept), ("drop", left)):
        # Each run is read once; of a place both are told by what its group holds.
        runs = places(job).select("*", F.lit(1).alias("run")).unionAll(places(job).select("*", F.lit(2)))
        told = runs.groupBy("_file", "_at").agg(F.min("run").alias("first"), F.max("run").alias("last"))
        first, both = F.count_if(F.col("first") == 1), F.count_if(F.col("first") != F.col("last"))
        found.append((f"batch {name}", *told.agg(first, both).first()))
    for way, source in (("landing", lambda: stream_logs(spark, logs)), ("tail", tailed)):
        found.append((f"{way} keep", streamed(source(), kept), streamed(source(), kept)))
    rows = spark.createDataFrame(found, "way string, kept bigint, again bigint")
    fair = F.col("kept").between(int(0.3 * total), int(0.7 * total) + 1)
    return rows.select("way", fair.alias("fair"), (F.col("kept") == F.col("again")).alias("same_again"))


@query("d09_rule_validation")
def _(spark, sf_dir):
    # Only the rules that pass the check are applied to the rows.
    offered = [
        Rule("???invalid", "drop"),
        Rule("status >= 500", "invalid"),
        Rule("status >= 500", "drop", 2.0),
        Rule("status + 1", "drop"),
        Rule("no_such_field = 1", "drop"),
        Rule("status >= 500", "drop"),
    ]
    accepted = []
    for rule in offered:
        try:
            check_rules(spark, [rule], RULE_FIELDS)
            accepted.append(rule)
        except ValueError:
            pass
    kept = apply_rules(parsed(spark, sf_dir), accepted, RULE_FIELDS)
    return kept.select("event_id", F.lit(len(accepted)).alias("accepted"))


# E: sink


def _stored(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "table")
    sink.append(table(spark, sf_dir), path)
    return path


def _in_files(spark: SparkSession, sf_dir: str, hours: int) -> str:
    """Lines in one file for each span of so many hours."""
    span = F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / (hours * 3600))
    source = events(spark, sf_dir)
    spans = source.select("event_id", span.alias("span"))
    rows = text_lines(source).join(spans, "event_id").select("span", "value")
    path = fresh_dir(spark, "lines")
    rows.repartition("span").write.partitionBy("span").text(path)
    return f"{path}/*"


@query("e1_append")
def _(spark, sf_dir):
    return rounded(spark.read.parquet(_stored(spark, sf_dir)).drop("month", "batch_id"), "RequestTime")


@query("e2_cadence")
def _(spark, sf_dir):
    # A batch each tenth of a second, one file of seven hours each: more than the progress list keeps.
    logs, out = _in_files(spark, sf_dir, 7), fresh_dir(spark, "table")
    job = Ingest(LINE_FORMAT, {"TimeLocal": "time_local", "Status": "status", "Request": "request"})
    run = start_ingest(stream_logs(spark, logs, 1), job, out, out + "-state", 0.1)
    run.processAllAvailable()
    run.stop()
    names = ("lines_read", "parse_errors", "lines_processed", "lines_stored")
    return batch_log(spark, out).agg(
        F.count(F.lit(1)).alias("batches"), *[F.sum(name).alias(name) for name in names]
    )


@query("e3_replay")
def _(spark, sf_dir):
    out = fresh_dir(spark, "table")
    early, rest = [
        map_columns(split_valid(parse_text(part, LINE_FORMAT))[0], TABLE_COLUMNS)
        for part in in_two(spark, sf_dir)
    ]
    older = early.withColumn("TimeLocal", F.col("TimeLocal") - F.expr("interval 31 days"))
    # The first attempt at batch 0 has rows of two months, its replay of one; rows that were loaded
    # in bulk stay beside them, and December, now without any, goes by expiry.
    for rows, batch_id in ((early.unionAll(older), 0), (early, 0), (rest, 1)):
        sink.replace_batch(rows, batch_id, out)
    sink.append(early.unionAll(older), out)
    retention.expire(spark, out, datetime(2024, 1, 31), 20)
    return spark.read.parquet(out).groupBy("month", "batch_id").agg(F.count(F.lit(1)).alias("cnt"))


@query("e4_months")
def _(spark, sf_dir):
    stored = spark.read.parquet(_stored(spark, sf_dir))
    return stored.groupBy("month").agg(F.count(F.lit(1)).alias("cnt"))


@query("e5_range_layout")
def _(spark, sf_dir):
    """Rows in the files of a month after it was laid out, and how many are out of order there."""
    path = _stored(spark, sf_dir)
    sink.lay_out_month(spark.read.parquet(path), path, 202401, 4)
    rows = spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    above = Window.partitionBy("file").orderBy("at")
    key = F.struct("Status", "TimeLocal")
    placed = rows.where("month = 202401").withColumn("before", F.lag(key).over(above))
    return placed.agg(
        F.count(F.lit(1)).alias("stored"),
        F.count_if(F.struct("Status", "TimeLocal") < F.col("before")).alias("out_of_order"),
        (F.count_distinct("file") > 1).alias("several_files"),
    )


@query("e5_crashed_layout")
def _(spark, sf_dir):
    """A layout that stops before its commit, readers then, and the layout done again."""
    path = _stored(spark, sf_dir)
    commit = Versions.commit

    def crash(self, *args, **options):
        raise InterruptedError("stopped on purpose")

    counts = []
    try:
        Versions.commit = crash
        sink.lay_out_month(sink.read_table(spark, path), path, 202401, 4)
    except InterruptedError:
        counts.append(("crashed", sink.read_table(spark, path).count()))
    finally:
        Versions.commit = commit
    sink.lay_out_month(sink.read_table(spark, path), path, 202401, 4)
    counts.append(("again", sink.read_table(spark, path).count()))
    return spark.createDataFrame(counts, "step string, stored bigint")


@query("e3_readers")
def _(spark, sf_dir):
    """What a reader that began before a replay sees, and one that begins after it."""
    out = fresh_dir(spark, "table")
    early, rest = [
        map_columns(split_valid(parse_text(part, LINE_FORMAT))[0], TABLE_COLUMNS)
        for part in in_two(spark, sf_dir)
    ]
    sink.replace_batch(early, 0, out)
    versions = Versions(spark, out)
    old = sink.read_table(spark, out)
    # The replay is committed; files of the version before stay for a while.
    parts = versions.write(sink.laid_out(rest).withColumn("batch_id", F.lit(0)))
    gone = versions.commit(parts, lambda part: part.batch == 0)
    seen = [("before", old.count()), ("after", sink.read_table(spark, out).count())]
    versions.remove(gone)
    seen.append(("removed", sink.read_table(spark, out).count()))
    return spark.createDataFrame(seen, "reader string, stored bigint")


@query("e8_without_a_time")
def _(spark, sf_dir):
    """Rows without a time go by the day they were loaded; those with one by theirs."""
    path = fresh_dir(spark, "table")
    lost = F.when(F.col("Status") < 300, F.col("TimeLocal"))
    sink.append(table(spark, sf_dir).withColumn("TimeLocal", lost), path)
    loaded = datetime.now()
    counts = []
    for step, as_of in (("kept", loaded), ("expired", loaded + timedelta(days=400))):
        retention.expire(spark, path, as_of, 180 if step == "expired" else 366 * 30)
        parts = Versions(spark, path).state().parts
        counts.append((step, sink.read_table(spark, path).count() if parts else 0))
    return spark.createDataFrame(counts, "step string, stored bigint")


@query("e6_date")
def _(spark, sf_dir):
    dated = sink.with_date(table(spark, sf_dir))
    return dated.groupBy(F.col("Date").alias("day")).agg(F.count(F.lit(1)).alias("cnt"))


@query("e7_contract")
def _(spark, sf_dir):
    spark.read.parquet(_stored(spark, sf_dir)).createOrReplaceTempView("stored_requests")
    wanted = {**TABLE_COLUMNS, "StatusClass": "_status_class"}
    return check_table(spark, "stored_requests", TABLE_COLUMNS).unionAll(
        check_table(spark, "stored_requests", wanted)
    )


@query("e8_unexpired")
def _(spark, sf_dir):
    rows = retention.unexpired(table(spark, sf_dir), datetime(2024, 7, 13), 180)
    return rows.groupBy(F.to_date("TimeLocal").alias("day")).agg(F.count(F.lit(1)).alias("cnt"))


@query("e8_expire")
def _(spark, sf_dir):
    path = fresh_dir(spark, "table")
    moved = table(spark, sf_dir).withColumn(
        "TimeLocal",
        F.when(F.col("Status") < 300, F.col("TimeLocal") - F.expr("interval 62 days"))
        .otherwise(F.col("TimeLocal")),
    )
    sink.append(moved, path)
    retention.expire(spark, path, datetime(2024, 1, 31), 45)
    return spark.read.parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("cnt"))


# F: panels


def _panel(
    name: str, build: Callable[[DataFrame], DataFrame], *doubles: str, digits: int = 10
) -> None:
    @query(name)
    def _(spark, sf_dir):
        return rounded(build(table(spark, sf_dir)), *doubles, digits=digits)


_SPAN = (START, END)
_panel("f00_time_range", lambda t: panels.in_range(t, "2024-01-08", "2024-01-09 12:00:00")
       .select("TimeLocal", "RemoteAddr", "Request"))
_panel("f01_total_requests", lambda t: panels.total_requests(t, *_SPAN))
_panel("f02_average_rps", lambda t: panels.average_rps(t, *_SPAN), "rps")
_panel("f03_error_rate", lambda t: panels.error_rate(t, *_SPAN), "error_rate")
_panel("f04_mean_response_time", lambda t: panels.mean_response_time(t, *_SPAN), "avg_time")
_panel("f05_p95", lambda t: panels.response_quantile(t, *_SPAN, 0.95, "p95"), "p95")
_panel("f06_p99", lambda t: panels.response_quantile(t, *_SPAN, 0.99, "p99"), "p99")
_panel("f07_status_class_series", lambda t: panels.status_class_series(t, *_SPAN, HOUR))
_panel("f08_by_method", lambda t: panels.by_method(t, *_SPAN))
_panel("f09_latency_series", lambda t: panels.latency_series(t, *_SPAN, HOUR), "avg", "p95", "p99")
_panel("f10_error_rate_series", lambda t: panels.error_rate_series(t, *_SPAN, HOUR),
       "error_4xx_5xx", "error_5xx")
_panel("f11_bandwidth_series", lambda t: panels.bandwidth_series(t, *_SPAN, HOUR))
_panel("f12_rps_series", lambda t: panels.rps_series(t, *_SPAN, HOUR), "rps")
_panel("f13_top_urls", lambda t: panels.top_urls(t, *_SPAN))
_panel("f14_top_clients", lambda t: panels.top_clients(t, *_SPAN))
_panel("f15_top_agents", lambda t: panels.top_agents(t, *_SPAN))
_panel("f16_slow_or_failed", lambda t: panels.slow_or_failed(t, *_SPAN), "RequestTime")
_panel("f17_buckets", lambda t: panels.rps_series(t, *_SPAN, 900), "rps")
_panel("f18_status_class_legend", lambda t: panels.roll_up(
    panels.status_class_series(t, *_SPAN, HOUR), ["cnt"], ["sum"], by="status_class"))
_panel("f18_latency_legend", lambda t: panels.roll_up(
    panels.latency_series(t, *_SPAN, HOUR), ["avg", "p95", "p99"], ["mean", "max"]), "mean", "max")
_panel("f18_error_rate_legend", lambda t: panels.roll_up(
    panels.error_rate_series(t, *_SPAN, HOUR), ["error_4xx_5xx", "error_5xx"], ["mean", "max"]),
    "mean", "max")
_panel("f18_bandwidth_legend", lambda t: panels.roll_up(
    panels.bandwidth_series(t, *_SPAN, HOUR), ["bytes_sent"], ["sum", "mean"]), "sum", "mean", digits=6)
_panel("f18_rps_legend", lambda t: panels.roll_up(
    panels.rps_series(t, *_SPAN, HOUR), ["rps"], ["mean", "max"]), "mean", "max")
_panel("f19_method_share", lambda t: panels.method_share(t, *_SPAN), "percent")
_panel("f20_error_rate_level", lambda t: panels.level(
    panels.error_rate(t, *_SPAN), "error_rate"), "error_rate")
_panel("f20_mean_level", lambda t: panels.level(
    panels.mean_response_time(t, *_SPAN), "avg_time"), "avg_time")
_panel("f20_p95_level", lambda t: panels.level(
    panels.response_quantile(t, *_SPAN, 0.95, "p95"), "p95"), "p95")
_panel("f20_p99_level", lambda t: panels.level(
    panels.response_quantile(t, *_SPAN, 0.99, "p99"), "p99"), "p99")
_panel("f21_slowest_first", lambda t: panels.slowest_first(t, *_SPAN), "RequestTime")


@query("f06_p99_sketch")
def _(spark, sf_dir):
    """Whether the share of values up to the sketch's quantile is right to a thousandth of the ranks."""
    rows = panels.in_range(table(spark, sf_dir), *_SPAN).where("RequestTime is not null")
    found = panels.response_quantile(rows, *_SPAN, 0.99, "p99", "sketch").first().p99
    count = F.count(F.lit(1))
    under, upto = F.count_if(F.col("RequestTime") < found), F.count_if(F.col("RequestTime") <= found)
    off = F.greatest(under - F.lit(0.99) * count, F.lit(0.99) * count - upto)
    return rows.agg(count.alias("requests"), (off <= 1 + count / 1000).alias("close"))


@query("f05_crowded_cell")
def _(spark, sf_dir):
    """Quantiles of clock-like values that differ in their last digits only."""
    rows = events(spark, sf_dir).select((F.lit(1.7e9) + F.col("event_id") / 1000).alias("msec"))
    names = {"p50": 0.5, "p95": 0.95}
    return exact_quantiles(value_counts(rows, "msec", []), "msec", names, []).select(
        *[F.round(name, 3).alias(name) for name in names]
    )


@query("f00_default_range")
def _(spark, sf_dir):
    """The last day of a table that also holds older months and a line dated years ahead."""
    path = fresh_dir(spark, "table")
    rows = table(spark, sf_dir)
    older = rows.withColumn("TimeLocal", F.col("TimeLocal") - F.expr("interval 62 days"))
    ahead = rows.limit(1).withColumn("TimeLocal", F.lit("2134-01-01").cast("timestamp_ntz"))
    sink.append(rows.unionAll(older), path)
    sink.append(ahead, path)
    day = panels.stored_range(spark, path)
    last = all("month=202401/" in name for name in day.inputFiles())
    return day.agg(
        F.count(F.lit(1)).alias("cnt"), F.max("TimeLocal").alias("newest"), F.lit(last).alias("one_month_read")
    )


@query("f00_stored_range")
def _(spark, sf_dir):
    # The same range on the stored table, where the month prunes the folders to read.
    stored = spark.read.parquet(_stored(spark, sf_dir))
    return panels.total_requests(stored, "2024-01-08", "2024-01-09 12:00:00")


# G: counters

COUNTED = Ingest(LINE_FORMAT, TABLE_COLUMNS, (Rule("contains(request, '/healthz')", "drop"),))


def _counted(spark: SparkSession, sf_dir: str, hours: int) -> str:
    """The table that a stream of files of so many hours, one per batch, has written."""
    logs, out = _in_files(spark, sf_dir, hours), fresh_dir(spark, "table")
    start_ingest(stream_logs(spark, logs, 1), COUNTED, out, out + "-state", None).awaitTermination()
    return out


@query("g1_line_counters")
def _(spark, sf_dir):
    return counters.line_counters(batch_log(spark, _counted(spark, sf_dir, 240)))


@query("g2_reconciliation")
def _(spark, sf_dir):
    out = _counted(spark, sf_dir, 240)
    return counters.reconciled(batch_log(spark, out), spark.read.parquet(out))


@query("g3_batch_sizes")
def _(spark, sf_dir):
    batches = batch_log(spark, _counted(spark, sf_dir, 72))
    return counters.histogram(batches, "lines_stored", counters.BATCH_SIZES)


@query("g4_flush_seconds")
def _(spark, sf_dir):
    """The histogram's bounds, whether it never falls, and its last row against the batches."""
    batches = batch_log(spark, _counted(spark, sf_dir, 240))
    found = counters.histogram(batches, "flush_seconds", counters.FLUSH_SECONDS)
    counts = F.array_sort(F.collect_list(F.struct(F.coalesce("le", F.lit(1e9)), "observations")))
    rising = F.transform(counts, lambda x: x["observations"]) == F.array_sort(F.collect_list("observations"))
    return found.agg(
        F.count("le").alias("bounds"), rising.alias("rising"), F.max("observations").alias("batches")
    )


@query("g5_bots")
def _(spark, sf_dir):
    return counters.bot_counters(agent_table(spark, sf_dir))


@query("g6_agent_reuse")
def _(spark, sf_dir):
    return rounded(counters.agent_reuse(agent_table(spark, sf_dir)), "hit_ratio")


# H: streams


@query("h1_stream_ingest")
def _(spark, sf_dir):
    logs = stored_lines(spark, lines(spark, sf_dir))
    out = fresh_dir(spark, "table")
    stream = stream_logs(spark, logs, max_files_per_trigger=100)
    job = Ingest(LINE_FORMAT, TABLE_COLUMNS, (Rule("contains(request, '/healthz')", "drop"),))
    start_ingest(stream, job, out, out + "-state", None).awaitTermination()
    return rounded(spark.read.parquet(out).drop("month", "batch_id"), "RequestTime")


@query("h1_stream_json")
def _(spark, sf_dir):
    logs, out = stored_lines(spark, json_lines(events(spark, sf_dir))), fresh_dir(spark, "table")
    job = Ingest(None, FULL_COLUMNS, (Rule("contains(request, '/healthz')", "drop"),), TAGS)
    start_ingest(stream_logs(spark, logs), job, out, out + "-state", None).awaitTermination()
    return rounded(spark.read.parquet(out).drop("month", "batch_id", "Date"), "RequestTime")


def _live(spark: SparkSession, sf_dir: str, build) -> DataFrame:
    logs, out = stored_lines(spark, lines(spark, sf_dir)), fresh_dir(spark, "live")
    rows = Ingest(LINE_FORMAT, TABLE_COLUMNS).run(stream_logs(spark, logs, 1))
    start_live(rows, build, HOUR, out, out + "-state", None).awaitTermination()
    return current(spark, out)


@query("h2_live_status_classes")
def _(spark, sf_dir):
    return _live(spark, sf_dir, live_status_classes)


@query("h2_live_traffic")
def _(spark, sf_dir):
    """The series; p95 and p99 by whether their ranks are right to one percent or one row."""
    found = _live(spark, sf_dir, live_traffic)
    rows = table(spark, sf_dir).select(panels.bucket(HOUR), "RequestTime")
    ranks = rows.join(found.select("time", "cnt", "p95", "p99"), "time").groupBy("time").agg(
        *[_close(name, share) for name, share in (("p95", 0.95), ("p99", 0.99))]
    )
    exact = found.drop("p95", "p99").join(ranks, "time")
    return rounded(exact, "avg", "error_4xx_5xx", "error_5xx", "rps")


def _close(name: str, share: float) -> Column:
    under = F.count_if(F.col("RequestTime") < F.col(name))
    upto = F.count_if(F.col("RequestTime") <= F.col(name))
    wanted = share * F.count("RequestTime")
    return (F.greatest(under - wanted, wanted - upto) <= 1 + F.max("cnt") / 100).alias(f"{name}_close")


@query("h2_live_range")
def _(spark, sf_dir):
    """Two days of a live series of many batches, and how few folders they are read from."""
    logs, out = _in_files(spark, sf_dir, 24), fresh_dir(spark, "live")
    rows = Ingest(LINE_FORMAT, TABLE_COLUMNS).run(stream_logs(spark, logs, 1))
    before = current_or_none(spark, out)
    start_live(rows, live_status_classes, HOUR, out, out + "-state", None).awaitTermination()
    few = len(live_tiers(spark, out).chosen()) <= 10
    found = current(spark, out, "2024-01-08 00:00:00", "2024-01-09 23:00:00")
    return found.select("*", F.lit(few).alias("few_folders"), F.lit(before is None).alias("none_before"))


@query("h2_live_tops")
def _(spark, sf_dir):
    """The three top lists of a stream, from its sketches and a recount of their candidates.

    Where the sketches leave a list open, all keys are counted.
    """
    logs, out = _in_files(spark, sf_dir, 240), fresh_dir(spark, "live")
    rows = Ingest(LINE_FORMAT, TABLE_COLUMNS).run(stream_logs(spark, logs, 1))
    start_live(rows, live_tops, 24 * HOUR, out, out + "-state", None).awaitTermination()
    lists = [
        settled_top(spark, out, table(spark, sf_dir), name, 24 * HOUR, *_SPAN)
        .select(F.lit(name).alias("kind"), F.col(name).alias("key"), "cnt", "rank", "sure")
        for name in ("url", "ip", "ua")
    ]
    return lists[0].unionAll(lists[1]).unionAll(lists[2])


@query("g6_live_reuse")
def _(spark, sf_dir):
    """Agents of a stream by sketches: exact counts, and whether the estimates are right to two percent."""
    logs, out = _in_files(spark, sf_dir, 240), fresh_dir(spark, "live")
    columns = {"TimeLocal": "time_local", "HttpUserAgent": "http_user_agent", "IsBot": "_is_bot"}
    rows = Ingest(LINE_FORMAT, columns).run(stream_logs(spark, logs, 1))
    start_live(rows, live_agents, 24 * HOUR, out, out + "-state", None).awaitTermination()
    exact = agent_table(spark, sf_dir)
    reuse, bots = counters.agent_reuse(exact), counters.bot_counters(exact)
    found = current_reuse(spark, out).withColumnRenamed("misses", "about").withColumnRenamed("bot_agents", "bots")
    # Single rows.
    both = found.drop("hits", "hit_ratio").join(reuse).join(bots.select("bot_agents"))
    return both.select(
        (F.col("hits") + F.col("misses")).alias("lookups"),
        "bot_requests",
        (F.abs(F.col("about") - F.col("misses")) <= 0.02 * F.col("misses")).alias("agents_close"),
        (F.abs(F.col("bots") - F.col("bot_agents")) <= 0.02 * F.col("bot_agents")).alias("bots_close"),
    )


def current_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return current(spark, path)
    except FileNotFoundError:
        return None


@query("h3_late_rows")
def _(spark, sf_dir):
    # The later half of the month arrives first; the table still takes every early line.
    early, rest = in_two(spark, sf_dir)
    logs, out = fresh_dir(spark, "lines"), fresh_dir(spark, "table")
    job = Ingest(LINE_FORMAT, TABLE_COLUMNS)
    for part in (rest, early):
        stored_lines(spark, part, logs)
        start_ingest(stream_logs(spark, logs), job, out, out + "-state", None).awaitTermination()
    stored = spark.read.parquet(out)
    return stored.groupBy(F.to_date("TimeLocal").alias("day")).agg(F.count(F.lit(1)).alias("cnt"))


@query("h4_restart")
def _(spark, sf_dir):
    early, rest = in_two(spark, sf_dir)
    logs, out = fresh_dir(spark, "lines"), fresh_dir(spark, "table")
    job = Ingest(LINE_FORMAT, TABLE_COLUMNS)
    for part in (early, rest):
        stored_lines(spark, part, logs)
        stream = stream_logs(spark, logs)
        start_ingest(stream, job, out, out + "-state", None).awaitTermination()
    return rounded(spark.read.parquet(out).drop("month", "batch_id"), "RequestTime")


@query("flagship")
def flagship(spark, sf_dir):
    """Lines to table rows to requests per hour and status class."""
    return panels.status_class_series(table(spark, sf_dir), START, END, HOUR)
