import gzip
import os
import shutil
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalog.fixture import LINE_FORMAT, events, text_lines
from loglode.operators import counters
from loglode.operators.rules import Rule
from loglode.plans import panels
from loglode.plans.pipeline import Ingest
from loglode.session import fresh_dir
from loglode.sources.files import read_logs, stream_logs
from loglode.sources.tail import TailSource
from loglode.operators.versions import FOLD, Part, Versions
from loglode.streaming import live
from loglode.streaming.ingest import batch_log, start_ingest
from loglode.streaming.tiers import Tiers

SF_DIR = "/root/testdata/sf0.001"
JOB = Ingest(LINE_FORMAT, rules=(Rule("status = 404", "drop"),))
SPAN = ("2024-01-01", "2024-02-01")


@pytest.fixture(scope="module")
def logs(spark):
    """The lines in several files."""
    path = fresh_dir(spark, "lines")
    text_lines(events(spark, SF_DIR)).repartition(6).select("value").write.text(path)
    return path


def test_stream_equals_batch_across_restarts(spark, logs, tmp_path):
    out, state = str(tmp_path / "t"), str(tmp_path / "s")

    def run():
        query = start_ingest(stream_logs(spark, logs, 1), JOB, out, state, None)
        query.awaitTermination()
        return query

    # Stopped after the first batches, then resumed on the same checkpoint, then run with no news.
    query = start_ingest(stream_logs(spark, logs, 1), JOB, out, state, 0)
    while not any(p.numInputRows for p in query.recentProgress):
        query.awaitTermination(0.2)
    query.stop()
    run()
    run()
    stored = spark.read.parquet(out)
    want = JOB.run(read_logs(spark, logs))
    got = stored.select(*want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    log = batch_log(spark, out)
    assert log.count() == 6 and log.agg(F.sum("lines_read")).first()[0] == 1000
    assert counters.reconciled(log, stored).first().balanced


def test_counters_tell_of_a_lost_file(spark, logs, tmp_path):
    out = str(tmp_path / "t")
    start_ingest(stream_logs(spark, logs, 2), JOB, out, str(tmp_path / "s"), None).awaitTermination()
    log = batch_log(spark, out)
    assert log.count() == 3
    sums = log.agg(*[F.sum(c).alias(c) for c in log.columns]).first()
    assert sums.lines_read == 1000
    assert sums.lines_read == sums.parse_errors + sums.lines_filtered + sums.lines_processed
    assert counters.line_counters(log).first().lines_not_processed == 0
    assert counters.reconciled(log, spark.read.parquet(out)).first().balanced
    next((tmp_path / "t").rglob("part-*.parquet")).unlink()
    assert not counters.reconciled(log, spark.read.parquet(out)).first().balanced


def test_two_streams_sample_alike(spark, logs, tmp_path):
    job = Ingest(LINE_FORMAT, rules=(Rule("status < 400", "drop", 0.5),))
    tables = []
    for run in "ab":
        out = str(tmp_path / run)
        start_ingest(stream_logs(spark, logs, 2), job, out, out + "-state", None).awaitTermination()
        tables.append(spark.read.parquet(out))
    assert 400 < tables[0].count() < 800
    assert tables[0].exceptAll(tables[1]).count() == tables[1].exceptAll(tables[0]).count() == 0


def test_live_series_equal_the_batch_panels(spark, logs, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "FOLD", 2)
    rows = JOB.run(stream_logs(spark, logs, 1))
    out = str(tmp_path / "live")
    live.start_live(rows, live.live_traffic, 3600, out, str(tmp_path / "s"), None).awaitTermination()
    # Six batches are read from two folders: one of four batches, one of two.
    assert live.live_tiers(spark, out).chosen() == [(1, 2), (2, 0)]
    found = live.current(spark, out)
    got = found.select("time", "bytes_sent", F.round("avg", 9).alias("avg"))
    table = JOB.run(read_logs(spark, logs))
    want = panels.bandwidth_series(table, *SPAN, 3600).join(
        panels.latency_series(table, *SPAN, 3600), "time"
    ).select("time", "bytes_sent", F.round("avg", 9).alias("avg"))
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_live_range_and_empty_series(spark, tmp_path):
    schema = "TimeLocal timestamp_ntz, Status int, BytesSent bigint, RequestTime double"
    land, out = tmp_path / "land", str(tmp_path / "live")
    land.mkdir()
    stream = spark.readStream.schema(schema).parquet(str(land))
    with pytest.raises(FileNotFoundError, match="no stream"):
        live.current(spark, out)
    live.start_live(stream, live.live_traffic, 60, out, str(tmp_path / "s"), None).awaitTermination()
    empty = live.current(spark, out)
    assert empty.count() == 0 and {"time", "cnt", "p95", "rps"} <= set(empty.columns)
    rows = spark.range(100).selectExpr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id) as TimeLocal", "200 as Status",
        "id as BytesSent", "0.5d as RequestTime"
    )
    rows.write.mode("append").parquet(str(land))
    live.start_live(stream, live.live_traffic, 60, out, str(tmp_path / "s"), None).awaitTermination()
    found = live.current(spark, out, "2024-01-02 00:00:00", "2024-01-02 03:00:00")
    assert sorted(r.time.hour for r in found.collect()) == [0, 1, 2, 3]
    assert "PushedFilters: [IsNotNull(time), GreaterThanOrEqual(time" in found._jdf.queryExecution().toString()


def test_live_tops_and_agents(spark, tmp_path, monkeypatch):
    """Few tracked keys: the heavy ones are found and counted exactly, and ``sure`` tells when."""
    monkeypatch.setattr(live, "TRACKED", 100)
    monkeypatch.setattr(live, "CANDIDATES", 20)
    rows = spark.range(20_000).selectExpr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id % 48) as TimeLocal",
        "concat('GET /', case when id % 10 < 4 then cast(id % 10 as string) when id % 10 < 9 then 'hot' else cast(id as string) end) as Request",
        "concat('10.0.0.', id) as RemoteAddr", "concat('agent ', id % 300) as HttpUserAgent",
        "cast(id % 300 < 30 as int) as IsBot",
    )
    land, out = str(tmp_path / "land"), str(tmp_path / "live")
    rows.repartition(4).write.parquet(land)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(land)
    for build in (live.live_tops, live.live_agents):
        path = f"{out}-{build.__name__}"
        live.start_live(stream, build, 3600, path, path + "-state", None).awaitTermination()
    span = ("2024-01-01 00:00:00", "2024-01-03 00:00:00")
    got = live.current_top(spark, f"{out}-live_tops", rows, "url", 3600, *span, top=4)
    want = [("/hot", 10_000), ("/0", 2_000), ("/1", 2_000), ("/2", 2_000)]
    assert [(r.url, r.cnt) for r in got.orderBy("rank").collect()] == want
    assert all(r.sure for r in got.collect())
    every = live.current_top(spark, f"{out}-live_tops", rows, "ip", 3600, *span)
    assert not any(r.sure for r in every.collect())
    none = live.current_top(spark, f"{out}-live_tops", rows, "ip", 3600, "2034-01-01", "2034-01-02")
    assert none.count() == 0
    reuse = live.current_reuse(spark, f"{out}-live_agents").first()
    assert abs(reuse.misses - 300) <= 6 and reuse.bot_requests == 2_010 and abs(reuse.bot_agents - 30) <= 1


def test_tiers_grow_with_the_logarithm(spark, tmp_path):
    tiers = Tiers(spark, str(tmp_path / "t"), merge=lambda rows: rows, fold=3)
    frame = spark.range(1)
    for number in range(30):
        tiers.add(frame.withColumn("batch", F.lit(number)), number)
        assert len(tiers.chosen()) <= 2 * 4 and len(tiers.listed()) <= 2 * 3 * 4
    # A replay of the last batch; a fold that is done again.
    tiers.add(frame.withColumn("batch", F.lit(29)), 29)
    tiers.fold_run(0, 9)
    assert sorted(r.batch for r in tiers.frame().collect()) == list(range(30))


def test_a_reader_in_time_misses_no_fold(spark, tmp_path):
    tiers = Tiers(spark, str(tmp_path / "t"), merge=lambda rows: rows, fold=2)
    for number in range(3):
        tiers.add(spark.range(10), number)
    before = tiers.frame()
    tiers.add(spark.range(10), 3)
    assert before.count() == 30 and tiers.frame().count() == 40


def test_work_per_batch_is_constant(spark, tmp_path):
    """What a batch opens and lists of the table's log does not grow over 200 batches."""
    path = str(tmp_path / "t")
    versions = Versions(spark, path)
    reads = []
    plain_read, plain_list = versions.folders.read, versions.folders.files_in
    versions.folders.read = lambda name: reads.append(1) or plain_read(name)
    versions.folders.files_in = lambda name: reads.extend(found := plain_list(name)) or found
    work = []
    for number in range(200):
        reads.clear()
        part = Part(f"month=202401/batch_id={number}", ("part-0.parquet",), 1, None, "2024-01-01 00:00:00")
        versions.commit([part], lambda part: part.batch == number)
        work.append(len(reads))
    assert max(work[100:]) <= max(work[40:100]) <= 3 * (2 * FOLD + 4)
    fresh = Versions(spark, path).state()
    assert fresh.number == versions.state().number and len(fresh.parts) == 200


def test_a_clock_in_the_future_shuts_out_nothing(spark, tmp_path):
    schema = "TimeLocal timestamp_ntz, Status int, BytesSent bigint, RequestTime double"
    land, out = tmp_path / "land", str(tmp_path / "live")
    land.mkdir()
    stream = spark.readStream.schema(schema).parquet(str(land))
    for time, count in (("2034-01-01 00:00:00", 1), ("2024-01-01 00:00:00", 50)):
        rows = spark.range(count).selectExpr(
            f"timestamp_ntz'{time}' as TimeLocal", "200 as Status", "id as BytesSent", "0.5d as RequestTime"
        )
        rows.write.mode("append").parquet(str(land))
        live.start_live(stream, live.live_traffic, 60, out, str(tmp_path / "s"), None).awaitTermination()
    assert sorted(r.cnt for r in live.current(spark, out).collect()) == [1, 50]


def tail(spark, path, out, state, **options):
    spark.dataSource.register(TailSource)
    stream = spark.readStream.format("log_tail").options(**options).load(path)
    query = (
        stream.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", state).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return Counter(r.value for r in spark.read.schema("value string").parquet(out).collect())


def test_tail_follows_appends_rotation_and_truncation(spark, tmp_path):
    log = tmp_path / "access.log"
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    said = []

    def say(*lines, end="\n"):
        with open(log, "a") as file:
            file.write("\n".join(lines) + end)
        said.extend(lines)

    def seen():
        return tail(spark, str(log), out, state, rangeBytes=50)

    say(*[f"first {i}" for i in range(100)])
    say("half a li", end="")
    said.pop()
    assert seen() == Counter(said)
    say("ne", "", "é日本")
    said[-3] = "half a line"
    assert seen() == Counter(said)
    # Lines written just before a rotation are read from the renamed file.
    say("last of the old file")
    os.rename(log, str(log) + ".1")
    say(*[f"second {i}" for i in range(100)])
    assert seen() == Counter(said)
    # The file is emptied in place and starts over.
    log.write_text("")
    say("after truncation")
    assert seen() == Counter(said)


@pytest.mark.parametrize("name", ["access.log-20240101", "access.log.1"])
def test_tail_rotation_by_name(spark, tmp_path, name):
    log = tmp_path / "access.log"
    at = (str(log), str(tmp_path / "out"), str(tmp_path / "state"))
    log.write_text("one\ntwo\n")
    assert tail(spark, *at) == Counter(["one", "two"])
    with open(log, "a") as file:
        file.write("three\n")
    os.rename(log, tmp_path / name)
    log.write_text("four\n")
    assert tail(spark, *at) == Counter(["one", "two", "three", "four"])


def test_tail_copy_and_truncate(spark, tmp_path):
    log = tmp_path / "access.log"
    at = (str(log), str(tmp_path / "out"), str(tmp_path / "state"))
    log.write_text("one\ntwo\n")
    assert tail(spark, *at) == Counter(["one", "two"])
    with open(log, "a") as file:
        file.write("three\n")
    shutil.copy(log, tmp_path / "access.log.1")
    # Between the copy and the emptying nothing comes twice.
    assert tail(spark, *at) == Counter(["one", "two", "three"])
    with open(log, "a") as file:
        file.write("four\n")
    shutil.copy(log, tmp_path / "access.log.1")
    log.write_text("")
    with open(log, "a") as file:
        file.write("five\n")
    assert tail(spark, *at) == Counter(["one", "two", "three", "four", "five"])


@pytest.mark.parametrize("packed", [True, False])
def test_tail_lost_log_is_an_error(spark, tmp_path, packed):
    log = tmp_path / "access.log"
    at = (str(log), str(tmp_path / "out"), str(tmp_path / "state"))
    log.write_text("one\n")
    tail(spark, *at)
    text = log.read_bytes() + b"two\n"
    # The old file stays somewhere, so that its inode is not used again at once.
    os.rename(log, tmp_path.parent / f"{tmp_path.name}-elsewhere")
    if packed:
        (tmp_path / "access.log.1.gz").write_bytes(gzip.compress(text))
    log.write_text("three\n")
    with pytest.raises(Exception, match="went away"):
        tail(spark, *at)


def test_tail_refuses_other_file_systems(spark, tmp_path):
    with pytest.raises(Exception, match="absolute local path"):
        tail(spark, "hdfs://host/access.log", str(tmp_path / "out"), str(tmp_path / "state"))


def test_tail_start_positions(spark, tmp_path):
    log = tmp_path / "access.log"
    log.write_text("old 1\nold 2\n")
    (tmp_path / "access.log.1").write_text("rotated long ago\n")
    late = (str(tmp_path / "o1"), str(tmp_path / "s1"))
    early = (str(tmp_path / "o2"), str(tmp_path / "s2"))
    assert tail(spark, str(log), *late, startingOffsets="latest") == Counter()
    assert tail(spark, str(log), *early) == Counter(["old 1", "old 2"])
    with open(log, "a") as file:
        file.write("new\n")
    assert tail(spark, str(log), *late, startingOffsets="latest") == Counter(["new"])
    assert tail(spark, str(log), *early) == Counter(["old 1", "old 2", "new"])


def test_batches_bounded_by_bytes(spark, logs, tmp_path):
    stream = stream_logs(spark, logs, max_bytes_per_trigger=1024)
    query = start_ingest(stream, JOB, str(tmp_path / "t"), str(tmp_path / "s"), None)
    query.awaitTermination()
    assert batch_log(spark, str(tmp_path / "t")).count() == 6


def test_settled_tops(spark, tmp_path, monkeypatch):
    """Many keys of like counts: no key of the sketches is sure, and the list is that of a full count."""
    monkeypatch.setattr(live, "TRACKED", 100)
    monkeypatch.setattr(live, "CANDIDATES", 20)
    rows = spark.range(20_000).selectExpr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, id % 48) as TimeLocal",
        "concat('GET /', case when id % 10 < 9 then 'hot' else cast(id % 5000 as string) end) as Request",
        # Two keys with six requests, all others with five.
        "concat('10.0.0.', case when id in (7777, 17002) then id - 5 else id % 4000 end) as RemoteAddr",
        "cast(id % 7 as string) as HttpUserAgent",
    )
    land, out = str(tmp_path / "land"), str(tmp_path / "live")
    rows.repartition(4).write.parquet(land)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(land)
    live.start_live(stream, live.live_tops, 3600, out, out + "-state", None).awaitTermination()
    span = ("2024-01-01 00:00:00", "2024-01-03 00:00:00")
    for name in ("url", "ip", "ua"):
        got = live.settled_top(spark, out, rows, name, 3600, *span).orderBy("rank").collect()
        key = live.TOP_KEYS[name]()
        counted = rows.groupBy(key.alias(name)).count().orderBy(F.desc("count"), name).limit(10).collect()
        assert [(r[name], r.cnt, r.sure) for r in got] == [(r[name], r["count"], True) for r in counted]
    assert not any(r.sure for r in live.current_top(spark, out, rows, "ip", 3600, *span).collect())
    assert live.settled_top(spark, out, rows, "ip", 3600, "2034-01-01", "2034-01-02").count() == 0
