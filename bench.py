"""Times the headline queries and prints one JSON line.

Log lines are rendered from ``events`` once and stored as text; the parsing and ingest queries read
those files. The panels read the month-partitioned table that ingest wrote. Every query runs once to
warm up; the reported time is the median of three further runs. The jobs in ``lines_per_second`` read the files
REPEAT times over, so that they show throughput and not planning.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog.checks import COUNTED, END, HOUR, START, TAGS  # noqa: E402
from catalog.fixture import LINE_FORMAT, events, json_lines, text_lines  # noqa: E402
from loglode.model import BASIC_COLUMNS, FULL_COLUMNS  # noqa: E402
from loglode.operators import counters, sink  # noqa: E402
from loglode.operators.rules import Rule  # noqa: E402
from loglode.plans import panels  # noqa: E402
from loglode.plans.pipeline import Ingest  # noqa: E402
from loglode.session import configure, fresh_dir  # noqa: E402
from loglode.sources.files import read_logs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
REPEAT = 10


def run_all(rows: DataFrame) -> None:
    """Work out every column of every row and throw the result away."""
    rows.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    source = events(spark, SF_DIR).repartition(int(CPUS), "event_id")
    text, objects = fresh_dir(spark, "bench-text"), fresh_dir(spark, "bench-json")
    text_lines(source).select("value").write.text(text)
    json_lines(source).select("value").write.text(objects)
    logs, json_logs = read_logs(spark, text), read_logs(spark, objects)

    basic = Ingest(LINE_FORMAT, {**BASIC_COLUMNS, "RequestTime": "request_time"})
    full = Ingest(LINE_FORMAT, FULL_COLUMNS, tags=TAGS)
    stored = fresh_dir(spark, "bench-table")
    sink.append(full.run(logs), stored)
    table = spark.read.parquet(stored)
    span = (START, END)
    ruled = Ingest(
        LINE_FORMAT, basic.columns,
        (Rule("contains(request, '/healthz')", "drop"), Rule("status >= 400", "keep")),
    )

    queries = {
        "parse_text": lambda: basic.run(logs),
        "parse_json": lambda: Ingest(None, basic.columns).run(json_logs),
        "enrich_full": lambda: full.run(logs),
        "rules": lambda: ruled.run(logs),
        "line_counters": lambda: COUNTED.judged(logs).agg(*counters.counter_columns()),
        "total_requests": lambda: panels.total_requests(table, *span),
        "average_rps": lambda: panels.average_rps(table, *span),
        "error_rate": lambda: panels.error_rate(table, *span),
        "mean_response_time": lambda: panels.mean_response_time(table, *span),
        "p95": lambda: panels.response_quantile(table, *span, 0.95, "p95"),
        "p99": lambda: panels.response_quantile(table, *span, 0.99, "p99"),
        "p99_sketch": lambda: panels.response_quantile(table, *span, 0.99, "p99", "sketch"),
        "status_class_series": lambda: panels.status_class_series(table, *span, HOUR),
        "by_method": lambda: panels.by_method(table, *span),
        "method_share": lambda: panels.method_share(table, *span),
        "latency_series": lambda: panels.latency_series(table, *span, HOUR),
        "latency_series_sketch": lambda: panels.latency_series(table, *span, HOUR, "sketch"),
        "error_rate_series": lambda: panels.error_rate_series(table, *span, HOUR),
        "bandwidth_series": lambda: panels.bandwidth_series(table, *span, HOUR),
        "rps_series": lambda: panels.rps_series(table, *span, HOUR),
        "top_urls": lambda: panels.top_urls(table, *span),
        "top_clients": lambda: panels.top_clients(table, *span),
        "top_agents": lambda: panels.top_agents(table, *span),
        "slow_or_failed": lambda: panels.slow_or_failed(table, *span),
        "bots": lambda: counters.bot_counters(table),
        "agent_reuse": lambda: counters.agent_reuse(table),
    }
    def timed(job) -> float:
        job()
        runs = []
        for _ in range(RUNS):
            begin = time.perf_counter()
            job()
            runs.append(time.perf_counter() - begin)
        return round(statistics.median(runs), 4)

    seconds = {name: timed(lambda build=build: run_all(build())) for name, build in queries.items()}
    seconds["ingest_to_table"] = timed(
        lambda: sink.append(full.run(logs), fresh_dir(spark, "bench-ingest"))
    )
    count = source.count()
    many, many_json = (read_logs(spark, [path] * REPEAT) for path in (text, objects))
    jobs = {
        "parse_text": lambda: run_all(basic.run(many)),
        "parse_json": lambda: run_all(Ingest(None, basic.columns).run(many_json)),
        "enrich_full": lambda: run_all(full.run(many)),
        "ingest_to_table": lambda: sink.append(full.run(many), fresh_dir(spark, "bench-ingest")),
    }
    rates = {name: round(REPEAT * count / timed(job)) for name, job in jobs.items()}

    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "lines": count,
        "lines_per_second": rates,
    }))


if __name__ == "__main__":
    main()
