"""The table's log: each change is seen whole or not at all, wherever a writer stops."""

from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loglode.operators import retention, sink
from loglode.operators.versions import FOLD, Conflict, Part, Versions
from loglode.plans import panels
from loglode.sources.folders import Folders


@pytest.fixture
def table(spark, tmp_path):
    """Two months in two bulk loads and a batch, and rows without a time."""
    path = str(tmp_path / "t")
    rows = spark.range(60).selectExpr(
        "timestamp_ntz'2024-01-15 00:00:00' + make_dt_interval(id % 30) as TimeLocal",
        "cast(200 + id % 5 as int) as Status", "id as BytesSent",
    )
    sink.append(rows.where("id % 6 < 3"), path)
    sink.append(rows.where("id % 6 in (3, 4)"), path)
    sink.replace_batch(rows.where("id % 6 = 5"), 0, path)
    sink.append(rows.limit(3).withColumn("TimeLocal", F.lit(None).cast("timestamp_ntz")), path)
    return path


def contents(spark, path):
    return sorted(r.BytesSent for r in sink.read_table(spark, path).collect())


class Crash(Exception):
    pass


def crashing_at(monkeypatch, step):
    """The file system stops working at one of its changing calls."""
    calls = [0]

    def patched(plain):
        def call(self, *args):
            calls[0] += 1
            if calls[0] > step:
                raise Crash
            return plain(self, *args)

        return call

    for name in ("publish", "move", "remove", "write", "remove_if_empty"):
        monkeypatch.setattr(Folders, name, patched(getattr(Folders, name)))
    return calls


@pytest.mark.parametrize("change", ["layout", "replay", "append", "expiry"])
def test_a_crash_at_any_point(spark, table, monkeypatch, change):
    more = spark.sql("select timestamp_ntz'2024-01-20 00:00:00' TimeLocal, 200 Status, 1000L BytesSent")
    before = contents(spark, table)
    batch = sorted(r.BytesSent for r in sink.read_table(spark, table).where("batch_id = 0").collect())
    january = [r.BytesSent for r in sink.read_table(spark, table).where("month = 202401").collect()]
    after, run = {
        "layout": (before, lambda: sink.lay_out_month(sink.read_table(spark, table), table, 202401, 2)),
        "replay": (sorted([x for x in before if x not in batch] + [1000]), lambda: sink.replace_batch(more, 0, table)),
        "append": (sorted([*before, 1000]), lambda: sink.append(more, table)),
        "expiry": (
            sorted((Counter(before) - Counter(january)).elements()),
            lambda: retention.expire(spark, table, datetime(2024, 3, 15), 31),
        ),
    }[change]
    step = 0
    while True:
        with monkeypatch.context() as patch:
            crashing_at(patch, step)
            try:
                run()
                break
            except Crash:
                pass
        found = contents(spark, table)
        assert found in (before, after), (change, step)
        if found == after and after != before:
            # The change was committed and only files that are no longer used are left over.
            break
        step += 3
    assert contents(spark, table) == after
    sink.clean(spark, table)
    assert contents(spark, table) == after
    assert sorted(r.BytesSent for r in spark.read.parquet(table).collect()) == after


def test_a_reader_that_began_before(spark, table):
    """With a grace period a reader of the version before reads on; without one it fails, but misses nothing."""
    old = sink.read_table(spark, table)
    before = contents(spark, table)
    versions = Versions(spark, table)
    gone = versions.commit([], lambda part: part.batch == 0)
    assert sorted(r.BytesSent for r in old.collect()) == before
    assert len(contents(spark, table)) == len(before) - 10
    versions.remove(gone)
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        old.collect()


def test_an_attempt_that_still_runs_commits_no_more(spark, table):
    versions = Versions(spark, table)
    first = versions.claim(7)
    second = versions.claim(7)
    part = Part("month=202401/batch_id=7", ("a.parquet",))
    with pytest.raises(Conflict):
        versions.commit([part], allowed=lambda: versions.holds(7, first))
    assert versions.holds(7, second) and part.key not in versions.state().parts


def test_layout_and_replay_of_one_month(spark, table, monkeypatch):
    """A batch that was replaced while its month was laid out is not brought back."""
    more = spark.sql("select timestamp_ntz'2024-01-20 00:00:00' TimeLocal, 200 Status, 1000L BytesSent")
    plain = Versions.write

    def write(self, rows, *args):
        parts = plain(self, rows, *args)
        monkeypatch.setattr(Versions, "write", plain)
        sink.replace_batch(more, 0, table)
        return parts

    monkeypatch.setattr(Versions, "write", write)
    with pytest.raises(Conflict):
        sink.lay_out_month(sink.read_table(spark, table), table, 202401, 2)
    assert 1000 in contents(spark, table) and len(contents(spark, table)) == 60 + 3 - 10 + 1
    assert sorted(r.BytesSent for r in spark.read.parquet(table).collect()) == contents(spark, table)


def test_a_table_without_a_log(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).selectExpr("timestamp_ntz'2024-01-15 00:00:00' TimeLocal", "200 Status", "id as BytesSent")
    rows.selectExpr("*", "202401 as month", "-1 as batch_id").write.partitionBy("month", "batch_id").parquet(path)
    assert contents(spark, path) == list(range(10))
    sink.append(rows, path)
    assert len(contents(spark, path)) == 20 and sink.clean(spark, path) == []
    with pytest.raises(FileNotFoundError):
        sink.read_table(spark, str(tmp_path / "none"))


def test_rows_without_a_time_expire_by_load_date(spark, table):
    nothing = F.col("TimeLocal").isNull()
    soon = datetime.now() + timedelta(days=10)
    retention.expire(spark, table, soon, 20)
    assert sink.read_table(spark, table).where(nothing).count() == 3
    retention.expire(spark, table, soon + timedelta(days=30), 20)
    assert Versions(spark, table).state().parts == {}
    with pytest.raises(FileNotFoundError):
        sink.read_table(spark, table)


def test_newest_and_default_range(spark, table):
    """One line dated years ahead changes nothing; only the months of the range are opened."""
    newest = datetime(2024, 2, 13)
    assert sink.newest(spark, table) == newest
    ahead = spark.sql("select timestamp_ntz'2134-01-01 00:00:00' TimeLocal, 200 Status, 5L BytesSent")
    sink.append(ahead, table)
    assert sink.newest(spark, table) == newest
    rows = panels.stored_range(spark, table)
    assert rows.agg(F.min("TimeLocal"), F.max("TimeLocal")).first()[:] == (datetime(2024, 2, 12), newest)
    assert all("month=202402/" in name for name in rows.inputFiles())
    assert panels.stored_range(spark, table, "2030-01-01", "2030-01-02").count() == 0
    both = panels.in_range(sink.read_table(spark, table))
    assert both.agg(F.min("TimeLocal"), F.max("TimeLocal")).first()[:] == (datetime(2024, 2, 12), newest)


def test_snapshots(spark, tmp_path):
    versions = Versions(spark, str(tmp_path / "t"))
    for i in range(3 * FOLD):
        versions.commit([Part(f"month=202401/batch_id={i}", ("f",))], lambda part: part.batch == i - 5)
    names = {path.name[0] for path in (tmp_path / "t" / "_log").iterdir()}
    assert {"s", "v"} <= names and len(list((tmp_path / "t" / "_log").glob("[vs]*"))) <= 2 * FOLD + 4
    assert sorted(part.batch for part in Versions(spark, str(tmp_path / "t")).state().parts.values()) == list(
        range(3 * FOLD - 5, 3 * FOLD)
    )
