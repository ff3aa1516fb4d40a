import pytest
from pyspark.sql import functions as F

from loglode.operators.rules import Rule, apply_rules, check_rules
from loglode.sources.files import read_logs
from loglode.sources.tail import TailSource

FIELDS = ["status", "request", "request_time", "gzip_ratio"]


def kept(spark, statuses, *rules, **change):
    rows = spark.createDataFrame([(s, change.get("request", "")) for s in statuses],
                                 "status string, request string")
    return [row.status for row in apply_rules(rows, list(rules), FIELDS).collect()]


def test_drop_keep_and_order(spark):
    ok = Rule("status >= 200 and status < 300", "drop")
    assert kept(spark, ["200", "500", "201"], ok) == ["500"]
    assert kept(spark, ["200", "503"], Rule("status >= 500", "keep")) == ["503"]
    chain = [Rule("status >= 500", "keep"), Rule("status = 503", "drop")]
    assert kept(spark, ["200", "500", "503"], *chain) == ["500"]
    assert kept(spark, ["200"]) == ["200"]


def test_numbers_are_never_null(spark):
    assert kept(spark, ["abc", "200"], Rule("status = 0", "keep")) == ["abc"]
    assert kept(spark, ["200"], Rule("request_time > 1", "keep")) == []
    assert kept(spark, [None], Rule("status = 0 and gzip_ratio = ''", "keep")) == [None]


def test_text_conditions(spark):
    health = {"request": "GET /health HTTP/1.1"}
    assert kept(spark, ["200"], Rule("contains(request, '/health')", "drop"), **health) == []
    assert kept(spark, ["200"], Rule("request rlike '^GET /health'", "drop"), **health) == []
    assert kept(spark, ["200"], Rule("not request rlike '^GET'", "drop"), **health) == ["200"]


def test_columns_come_back_unchanged(spark):
    rows = spark.createDataFrame([(" 5 ", 1)], "status string, other int")
    out = apply_rules(rows, [Rule("status = 0", "keep")], FIELDS)
    assert out.columns == rows.columns and tuple(out.first()) == (" 5 ", 1)


def test_equal_lines_of_a_file(spark, tmp_path):
    """A share of them is kept, the same lines each time, whatever else is read beside the file."""
    (tmp_path / "access.log").write_text("200\n" * 10_000)
    lines = read_logs(spark, str(tmp_path)).withColumn("status", F.col("value"))
    rule = Rule("status = 200", "keep", 0.5)
    one, other = [{r._at for r in apply_rules(lines, [rule], FIELDS).collect()} for _ in range(2)]
    assert one == other and 4_500 < len(one) < 5_500
    rows = spark.createDataFrame([("200",)] * 10_000, "status string")
    assert 4_500 < apply_rules(rows, [rule], FIELDS).count() < 5_500


def test_places_in_a_tailed_file(spark, tmp_path):
    """``_at`` is the byte where a line begins, in whatever ranges the file is read."""
    text = "".join(f"{'é' * (i % 7)} line {i % 3}\n" for i in range(500)).encode()
    (tmp_path / "access.log").write_bytes(text)
    spark.dataSource.register(TailSource)
    stream = spark.readStream.format("log_tail").option("rangeBytes", 1000).load(str(tmp_path / "access.log"))
    out = str(tmp_path / "out")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-state").trigger(
        availableNow=True
    ).start().awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert len({r._at for r in rows}) == 500
    assert all(text[r._at :].startswith(r.value.encode() + b"\n") for r in rows)
    assert all(r._at == 0 or text[r._at - 1 : r._at] == b"\n" for r in rows)


@pytest.mark.parametrize("key", ["id", None])
def test_sampling(spark, key):
    same = spark.range(10_000).selectExpr("id", "'200' as status")
    def count(action, rate):
        return apply_rules(same, [Rule("status = 200", action, rate)], FIELDS, key).count()

    for action in ("drop", "keep"):
        assert 4_500 < count(action, 0.5) < 5_500
    assert count("drop", 1.0) == count("drop", 0.0) == 0
    assert count("keep", 1.0) == count("keep", 0.0) == 10_000


def test_sampling_is_reproducible_monotone_and_independent(spark):
    same = spark.range(2_000).selectExpr("id", "'200' as status")
    def ids(*rules):
        return {r.id for r in apply_rules(same, list(rules), FIELDS, "id").collect()}

    few, more = Rule("status = 200", "keep", 0.2), Rule("status = 200", "keep", 0.6)
    assert ids(few) == ids(few) and ids(few) < ids(more)
    # Two equal rules draw apart from each other.
    assert 0.02 < len(ids(few, few)) / 2_000 < 0.07


@pytest.mark.parametrize(
    "rule",
    [
        Rule("???invalid", "drop"), Rule("status = 1", "invalid"), Rule("status = 1", "drop", -0.5),
        Rule("status = 1", "drop", 2.0), Rule("status + 1", "drop"), Rule("nope = 1", "drop"),
        Rule("_hostname = 'x'", "drop"),
    ],
)
def test_invalid_rules(spark, rule):
    with pytest.raises(ValueError):
        check_rules(spark, [rule], FIELDS)


@pytest.mark.parametrize("action", ["drop", "keep"])
@pytest.mark.parametrize("rate", [0.0, 0.0001])
def test_a_null_condition_lets_the_row_pass(spark, action, rate):
    rule = Rule("try_divide(1, status) > 0", action, rate)
    assert kept(spark, ["0"], rule) == ["0"]
