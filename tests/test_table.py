from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loglode.operators import counters, retention, sink
from loglode.operators.contract import check_table
from loglode.operators.quantiles import cell, exact_quantiles, sketch_quantiles, value_counts
from loglode.plans import panels


@pytest.fixture(scope="module")
def requests(spark):
    """Requests over four months with odd statuses, ties and missing numbers."""
    return spark.range(4_000).selectExpr(
        "cast(timestamp_ntz'2023-11-01 00:00:00' + make_interval(0,0,0,0,0,0,id*2400) as timestamp_ntz)"
        " as TimeLocal",
        "cast(array(200,404,500,null,99)[id % 5] as int) as Status",
        "id % 7 as BytesSent",
        "case when id % 11 = 0 then null else cast(pow(id % 37 - 5, 3) / 100 as double) end as RequestTime",
        "concat('GET /', id % 3, ' HTTP/1.1') as Request",
        "concat('10.0.0.', id % 4) as RemoteAddr",
    )


def test_append_and_prune(spark, requests, tmp_path):
    path = str(tmp_path / "t")
    sink.append(requests, path)
    sink.append(requests.limit(0), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 4_000 and "Date" in stored.columns
    january = panels.total_requests(stored, "2024-01-05", "2024-01-06")
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "month#" in plan and "PartitionFilters: [isnotnull(month" in plan
    want = requests.where("TimeLocal between '2024-01-05' and '2024-01-06'").count()
    assert january.first().total == want


def sorted_files(spark, folder):
    for file in folder.glob("month=*/*/*.parquet"):
        rows = [(r.Status is not None, r.Status, r.TimeLocal)
                for r in spark.read.parquet(str(file)).collect()]
        assert rows == sorted(rows, key=lambda r: (r[0], r[1] or 0, r[2]))


def test_files_are_sorted(spark, requests, tmp_path):
    path = str(tmp_path / "t")
    sink.append(requests, path)
    for batch in (3, 4):
        sink.replace_batch(requests.limit(500), batch, path)
    sorted_files(spark, tmp_path / "t")
    sink.lay_out_month(spark.read.parquet(path), path, 202311, 4)
    sorted_files(spark, tmp_path / "t")
    assert len(list((tmp_path / "t").glob("month=202311/*/*.parquet"))) == 4
    assert not (tmp_path / "t-month-202311").exists()
    stored = spark.read.parquet(path)
    assert stored.count() == 5_000 and stored.where("month = 202311 and batch_id >= 0").isEmpty()


def test_a_crowded_second_still_splits(spark, tmp_path):
    same = spark.range(2_000).selectExpr(
        "timestamp_ntz'2024-01-01 00:00:00' as TimeLocal", "200 as Status", "id as BytesSent"
    )
    path = str(tmp_path / "t")
    sink.append(same, path)
    sink.lay_out_month(spark.read.parquet(path), path, 202401, 4)
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 4


def test_one_table_for_streams_bulk_replay_and_expiry(spark, requests, tmp_path):
    path = str(tmp_path / "t")
    sink.replace_batch(requests, 0, path)
    sink.append(requests, path)
    # The replay has rows of one month only; those of the others go.
    sink.replace_batch(requests.where("TimeLocal < '2023-12-01'"), 0, path)
    stored = spark.read.parquet(path)
    assert [r.month for r in stored.where("batch_id = 0").select("month").distinct().collect()] == [202311]
    assert stored.where("batch_id = -1").count() == 4_000
    retention.expire(spark, path, datetime(2024, 2, 10), 60)
    assert spark.read.parquet(path).agg(F.min("month")).first()[0] == 202312


def test_append_refuses_a_file_sink_table(spark, requests, tmp_path):
    (tmp_path / "t" / "_spark_metadata").mkdir(parents=True)
    with pytest.raises(ValueError, match="file-sink"):
        sink.append(requests, str(tmp_path / "t"))


def test_append_table(spark, requests):
    sink.laid_out(requests).limit(0).write.mode("overwrite").saveAsTable("requests_table")
    try:
        sink.append_table(sink.laid_out(requests), "requests_table")
        assert spark.table("requests_table").count() == 4_000
    finally:
        spark.sql("DROP TABLE requests_table")


def test_replaced_batch(spark, requests, tmp_path):
    path = str(tmp_path / "t")
    for batch in (0, 0, 1):
        sink.replace_batch(requests.limit(10), batch, path)
    assert spark.read.parquet(path).count() == 20


def test_contract(spark, requests):
    requests.createOrReplaceTempView("checked_table")
    plain = {"Status": "status", "Request": "request"}
    assert [r.ok for r in check_table(spark, "checked_table", plain).collect()] == [True] * 4
    wrong = check_table(spark, "checked_table", {**plain, "Nope": "nope"}).collect()
    assert [r.ok for r in wrong] == [True, True, True, False] and "Nope" in wrong[3].message
    assert [r.ok for r in check_table(spark, "no_table", plain).collect()] == [True, True, False]
    gone = check_table(spark, "t", plain, database="no_db").collect()
    assert [r.ok for r in gone] == [True, False]


def test_expire(spark, requests, tmp_path):
    path = str(tmp_path / "t")
    sink.append(requests, path)
    assert retention.expire(spark, path, datetime(2024, 2, 10), 60) == [202311]
    months = {r.month for r in spark.read.parquet(path).select("month").distinct().collect()}
    assert months == {202312, 202401, 202402}
    left = retention.unexpired(spark.read.parquet(path), datetime(2024, 2, 10), 60)
    assert left.agg(F.min("TimeLocal")).first()[0] > datetime(2023, 12, 12)


@pytest.mark.parametrize("by", [[], ["Status"], ["Status", "BytesSent"]])
def test_exact_quantiles(spark, requests, by):
    names = {"q0": 0.0, "q1": 0.01, "q50": 0.5, "q95": 0.95, "q99": 0.99, "q100": 1.0}
    got = exact_quantiles(value_counts(requests, "RequestTime", by), "RequestTime", names, by)
    want = requests.groupBy(*by).agg(
        *[F.percentile("RequestTime", p).alias(n) for n, p in names.items()]
    )
    key = lambda row: tuple(str(row[name]) for name in by)
    got, want = sorted(got.collect(), key=key), sorted(want.collect(), key=key)
    assert len(got) == len(want)
    for one, other in zip(got, want):
        assert key(one) == key(other)
        assert [one[n] for n in names] == pytest.approx([other[n] for n in names])


def test_quantile_of_nothing(spark, requests):
    none = requests.where("RequestTime > 1e9")
    got = exact_quantiles(value_counts(none, "RequestTime", []), "RequestTime", {"p": 0.9}, [])
    assert [r.p for r in got.collect()] == [None]


def test_sketch_is_close(spark, requests):
    got = sketch_quantiles(requests, "RequestTime", {"p": 0.95}, []).first().p
    assert got == pytest.approx(requests.agg(F.percentile("RequestTime", 0.95)).first()[0], rel=0.05)


def test_cells_never_fall(spark):
    values = [float("-inf"), -1e300, -2.0, -1e-300, 0.0, 5e-324, 1e-9, 0.001, 0.0011, 1.0, 1e300,
              float("inf"), float("nan")]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v double")
    cells = [r.c for r in rows.select("id", cell(F.col("v")).alias("c")).orderBy("id").collect()]
    assert cells == sorted(cells)


def test_bucket_without_any_latency_keeps_its_row(spark):
    rows = spark.sql("select timestamp_ntz'2024-01-01 00:10:00' TimeLocal, cast(null as double) RequestTime"
                     " union all select timestamp_ntz'2024-01-01 01:10:00', 2.0D")
    got = panels.latency_series(rows, "2024-01-01", "2024-01-02", 3600).collect()
    assert [(r.avg, r.p95) for r in got] == [(None, None), (2.0, 2.0)]


def test_empty_range(spark, requests):
    span = ("1999-01-01", "1999-01-02")
    assert panels.total_requests(requests, *span).first().total == 0
    assert panels.average_rps(requests, *span).first().rps == 0
    assert panels.error_rate(requests, *span).first().error_rate == 0
    assert panels.mean_response_time(requests, *span).first().avg_time is None
    assert panels.method_share(requests, *span).collect() == []


def test_range_is_inclusive_and_defaults_to_a_day(spark):
    rows = spark.sql("select explode(array(timestamp_ntz'2024-01-01 00:00:00', "
                     "timestamp_ntz'2024-01-02 00:00:00', timestamp_ntz'2024-01-02 00:00:01')) TimeLocal")
    assert panels.in_range(rows, "2024-01-01", "2024-01-02").count() == 2
    assert panels.in_range(rows, end="2024-01-02 00:00:01").count() == 2


def test_unbounded_status_class(spark, requests):
    classes = panels.status_class_series(requests, "2023-01-01", "2025-01-01", 86400 * 400)
    assert {r.status_class for r in classes.collect()} == {"2xx", "4xx", "5xx", "0xx", None}


def test_panels_scan_once(spark, requests, tmp_path):
    sink.append(requests, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    span = ("2023-01-01", "2025-01-01")
    for panel in (
        panels.response_quantile(stored, *span, 0.95, "p95"),
        panels.latency_series(stored, *span, 3600),
        panels.method_share(stored, *span),
    ):
        panel.collect()
        plan = panel._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert final.count("FileScan") <= 1 + plan.count("ReusedExchange") and "ReusedExchange" in plan


def test_levels(spark):
    rows = spark.createDataFrame([(0.99,), (1.0,), (4.99,), (5.0,), (None,)], "error_rate double")
    got = [r.level for r in panels.level(rows, "error_rate").collect()]
    assert got == ["green", "yellow", "yellow", "red", "green"]


def test_histogram(spark):
    rows = spark.createDataFrame([(5,), (10,), (11,), (20_000,)], "n int")
    got = [(r.le, r.observations) for r in counters.histogram(rows, "n", counters.BATCH_SIZES).collect()]
    assert got[:2] == [(10.0, 2), (50.0, 3)] and got[-2:] == [(10_000.0, 3), (None, 4)]
