import pytest
from pyspark.sql import functions as F

from loglode.model import MAIN_FORMAT
from loglode.operators.parse import NO_MATCH, compile_format, parse_text, split_valid
from loglode.operators.parse_json import parse_json
from loglode.operators.typed import cast_fields
from loglode.sources.files import normalise, read_logs

SHORT = '$remote_addr - $remote_user [$time_local] "$request" $status $body_bytes_sent'
# Lines, JSON scalars and typed fields with the results they must give.
GOOD = [
    '192.168.1.1 - frank [10/Oct/2000:13:55:36 -0700] "GET /index.html HTTP/1.0" 200 2326',
    '10.0.0.1 - - [10/Oct/2000:13:55:37 -0700] "POST /form HTTP/1.1" 301 512',
]


def column(rows, name):
    return [row[name] for row in rows.orderBy("id").collect()]


def test_text_lines(lines):
    rows = parse_text(lines(*GOOD), SHORT)
    assert column(rows, "_error") == [None, None]
    assert column(rows, "remote_addr") == ["192.168.1.1", "10.0.0.1"]
    assert column(rows, "remote_user") == ["frank", "-"]
    assert column(rows, "request") == ["GET /index.html HTTP/1.0", "POST /form HTTP/1.1"]
    assert column(rows, "status") == ["200", "301"]
    assert column(rows, "body_bytes_sent") == ["2326", "512"]


def test_bad_lines_are_split_off(lines):
    junk = ["invalid log line that should not crash", "", GOOD[0]]
    good, bad = split_valid(parse_text(lines(*junk), SHORT))
    assert good.count() == 1 and "_error" not in good.columns
    assert sorted((r.value, r._error) for r in bad.collect()) == [("", NO_MATCH), (junk[0], NO_MATCH)]


def test_empty_fields_and_text_after_the_last_field(lines):
    line = ' - - [10/Oct/2000:13:55:36 -0700] "" 0 0 "" "" 0.123 more'
    row = parse_text(lines(line), MAIN_FORMAT).first()
    assert row._error is None
    assert (row.remote_addr, row.request, row.status, row.http_user_agent) == ("", "", "0", "")


@pytest.mark.parametrize("mark", ["\u0001", "\u0002", "\u0002\u0001", "$1", "\\", "é日"])
def test_any_character_inside_a_field(lines, mark):
    line = GOOD[0].replace("/index.html", f"/a{mark}b")
    row = parse_text(lines(line, "bad" + mark), SHORT).orderBy("id").collect()
    assert row[0].request == f"GET /a{mark}b HTTP/1.0" and row[0].status == "200"
    assert row[1]._error == NO_MATCH and row[1].status is None


def test_lines_of_any_length(lines):
    for size in (1024 * 1024, 3_000_000):
        line = GOOD[0].replace("/index.html", "/" + "a" * size)
        row = parse_text(lines(line), SHORT).first()
        assert row._error is None and len(row.request) == size + len("GET / HTTP/1.0")
        json = '{"status": 200, "request": "' + "a" * size + '"}'
        row = parse_json(lines(json), ["status", "request"]).first()
        assert row._error is None and row.status == "200" and len(row.request) == size


@pytest.mark.parametrize("bad", ["no fields", "$a$b", "$a $a"])
def test_format_errors(bad):
    with pytest.raises(ValueError):
        compile_format(bad)


def test_normalise(lines):
    rows = normalise(lines(" \t a b \r", "\u00a0x\u3000\v", "", "\n"))
    assert column(rows, "value") == ["a b", "x", "", ""]


def test_files_split_at_line_feeds_only(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"one\r\ntwo\rhalf\nthree")
    got = normalise(read_logs(spark, str(tmp_path)))
    assert sorted(r.value for r in got.collect()) == ["one", "three", "two\rhalf"]


def test_gz_and_start_time(spark, tmp_path):
    import gzip
    import os

    (tmp_path / "old.log.gz").write_bytes(gzip.compress(b"old\n"))
    (tmp_path / "new.log").write_bytes(b"new\n")
    os.utime(tmp_path / "old.log.gz", (10**9, 10**9))
    assert sorted(r.value for r in read_logs(spark, str(tmp_path)).collect()) == ["new", "old"]
    late = read_logs(spark, str(tmp_path), modified_after="2010-01-01T00:00:00")
    assert [r.value for r in late.collect()] == ["new"]


JSON_VALUES = [
    ("42", "42"), ("3.14", "3.14"), ("true", "true"), ("false", "false"), ("null", ""),
    ('"hello"', "hello"), ("5.0", "5"), ("0.10", "0.1"), ("1e3", "1000"), ("1.5E-5", "0.000015"),
    ("1e22", "1" + "0" * 22), ("9.5e21", "95" + "0" * 20), ("-2.5e0", "-2.5"), ("-1e2", "-100"),
    ('"5.00"', "5.00"), ('"1e3"', "1e3"), ('"1000.0"', "1000.0"), ('"[x"', "[x"), ('""', ""),
    ('{"z":1,"a":"<"}', '{"a":"\\u003c","z":1}'), ('[1, 2.50,"q"]', '[1,2.5,"q"]'),
    ("12.5e1", "125"), ("1.25e1", "12.5"), ("0e5", "0"), ("123456.789e-3", "123.456789"),
    ("0.05e0", "0.05"),
]


def test_json_values(lines):
    rows = parse_json(lines(*[f'{{"v":{text}}}' for text, _ in JSON_VALUES]), ["v"])
    assert column(rows, "v") == [want for _, want in JSON_VALUES]
    assert set(column(rows, "_error")) == {None}


def test_json_lines_good_and_bad(lines):
    texts = [
        '{"status":200,"remote_addr":"1.1.1.1"}', "not valid json", "", "{}", "[1]", '"x"', "7",
        '{"a":1} x', '{"a":1} {"b":2}', '{"a":1},{"b":2}', '{"a":1}],[{}', "null", '{"a":1,}',
        '{"nested":{"key":"value"},"array":[1,2,3]}', '{"status":1,"status":2}', '{"a":NaN}',
    ]
    rows = parse_json(lines(*texts), ["status", "nested"])
    good = [i for i, error in enumerate(column(rows, "_error")) if error is None]
    assert [texts[i] for i in good] == [texts[0], "{}", "null", texts[13], texts[14]]
    assert column(rows, "status")[0] == "200" and column(rows, "status")[14] == "2"
    assert column(rows, "nested")[13] == '{"key":"value"}'
    assert column(rows, "status")[3] is None


def test_json_keys_with_odd_characters(lines):
    rows = parse_json(lines('{"a b":1,"c.d":2,"$e":3}'), ["a b", "c.d", "$e"]).first()
    assert (rows["a b"], rows["c.d"], rows["$e"]) == ("1", "2", "3")


TYPED = [
    ("time_local", "04/Nov/2018:12:30:45 +0000", "2018-11-04 12:30:45"),
    ("time_local", "10/Oct/2000:13:55:36 -0700", "2000-10-10 13:55:36"),
    ("time_local", "10/oct/2000:13:55:36 -0700", "2000-10-10 13:55:36"),
    ("time_local", "invalid-time", None),
    ("time_local", "31/Feb/2000:13:55:36 +0000", None),
    ("time_local", "10/Oct/2000:13:55:60 +0000", None),
    ("time_local", "10/Oct/2000:24:00:00 +0000", None),
    ("time_local", "10/Xyz/2000:13:55:36 +0000", None),
    ("time_local", "10/Oct/2000:13:55:36", None),
    ("bytes_sent", "1024", "1024"), ("status", "200", "200"), ("connection", "42", "42"),
    ("request_length", "512", "512"), ("body_bytes_sent", "+7", "7"), ("status", "OK", None),
    ("bytes_sent", " 7", None), ("bytes_sent", "7.0", None), ("bytes_sent", "", None),
    ("bytes_sent", "99999999999999999999", None), ("status", "9999999999", None),
    ("request_time", "0.123", "0.123"), ("msec", "12345.678", "12345.678"),
    ("request_time", "1.0d", None), ("request_time", "-", None), ("request_time", "1e400", None),
    ("request_time", "0.1, 0.2", None), ("request_time", ".5", "0.5"),
    ("request_time", "inf", "Infinity"), ("request_time", "1e3", "1000.0"),
    ("http_referer", "x", "x"), ("anything", " y", " y"),
]


@pytest.mark.parametrize("field", sorted({field for field, _, _ in TYPED}))
def test_typed_fields(spark, field):
    cases = [(i, raw, want) for i, (name, raw, want) in enumerate(TYPED) if name == field]
    rows = spark.createDataFrame(cases, f"id int, {field} string, want string")
    got = cast_fields(rows, [field]).withColumn("got", F.col(field).cast("string"))
    for row in got.collect():
        assert row.got == row.want
        assert row._bad_fields == ([] if row.want is not None else [field])


def test_wall_clock_ignores_the_session_time_zone(spark):
    rows = spark.createDataFrame([("10/Mar/2024:02:30:00 +0100",)], "time_local string")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = cast_fields(rows, ["time_local"]).select(F.col("time_local").cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == "2024-03-10 02:30:00"
