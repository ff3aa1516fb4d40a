import socket

import pytest
from pyspark.sql import functions as F

from catalog.fixture import AGENTS
from loglode.functions.text import status_class
from loglode.functions.urls import request_extension, url_host
from loglode.operators.columns import Tags, map_columns

CASES = {
    status_class: [
        ("200", "2xx"), ("301", "3xx"), ("404", "4xx"), ("500", "5xx"), ("OK", ""), ("099", ""),
        ("600", ""), ("", ""), (None, ""),
    ],
    url_host: [
        ("https://example.com/page?q=1", "example.com"),
        ("https://example.com:8080/page", "example.com"),
        ("http://sub.domain.org/path", "sub.domain.org"),
        ("-", ""), ("", ""), (None, ""), ("/local/path", ""), ("://bad", ""),
        ("http://[::1]:80/x", "::1"), ("http://a_b.com", "a_b.com"), ("http://u:p@h/", "h"),
        ("http://u@v@h/", "h"), ("//host/path", "host"), ("http:///x", ""), ("mailto:a@b.c", ""),
        ("http://a b/", ""), ("http://h/%zz", ""), ("http://h/?q=%zz", "h"), ("http://h/%41", "h"),
        ("http://h/#%zz", ""), ("http://h/#a?%zz", ""), ("http://h:80a/", ""), ("http://h:/", "h"),
        ("HTTP://Host.COM", "Host.COM"), ("1http://h/", ""), ("http://münchen.de/x", "münchen.de"),
        ("http://h/\tx", ""), ("http://h?x=//y", "h"),
    ],
    request_extension: [
        ("GET /index.html HTTP/1.1", "html"), ("GET /app.js?v=123 HTTP/1.1", "js"),
        ("GET /style.css#section HTTP/1.1", "css"), ("GET /api/users HTTP/1.1", ""),
        ("GET / HTTP/1.1", ""), ("GET /logo.png HTTP/2.0", "png"), ("GET /.env HTTP/1.1", "env"),
        ("", ""), ("GET", ""), (None, ""), ("GET /a.b/c HTTP/1.1", ""), ("GET /a. HTTP/1.1", ""),
        ("GET /LOGO.PNG", "png"), ("GET /x.tar.gz HTTP/1.1", "gz"), ("GET  /a.js", ""),
        ("GET /a?b=/c.d HTTP/1.1", ""), ("GET /a.js#x?y.z HTTP/1.1", "js"),
    ],
}


@pytest.mark.parametrize("build", CASES, ids=lambda f: f.__name__)
def test_derived_texts(spark, build):
    rows = spark.createDataFrame(CASES[build], "raw string, want string")
    assert rows.select("raw", "want", build(F.col("raw")).alias("got")).where(
        "not got <=> want"
    ).collect() == []


def agents(spark, *texts):
    columns = {
        "bot": "_is_bot", "name": "_bot_name", "class": "_bot_class", "browser": "_browser",
        "version": "_browser_version", "os": "_os", "device": "_device_type",
    }
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, http_user_agent string")
    mapped = map_columns(rows, columns, keep=("id",)).orderBy("id").collect()
    assert all(row.bot in (0, 1) for row in mapped)
    return [{**row.asDict(), "bot": str(row.bot)} for row in mapped]


def test_is_bot(spark):
    want = ["1", "1", "1", "1", "0", "0", "0", "0", "1", "1", "1", "1", "1", "1"]
    assert [row["bot"] for row in agents(spark, *AGENTS)] == want


def test_agent_details(spark):
    google, chrome, empty = agents(spark, AGENTS[0], AGENTS[4], "")
    assert (google["name"], google["class"]) == ("Googlebot", "search")
    assert (chrome["browser"], chrome["version"], chrome["os"], chrome["device"]) == (
        "Chrome", "120", "Linux", "desktop")
    assert (empty["bot"], empty["browser"], empty["device"]) == ("0", "", "unknown")


# User agents and what must be found in them.
AGENT_CASES = [
    ("Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/120.0.0.0 Safari/537.36 Edg/120.0.2210.61", "0", "", "Edge", "120", "Windows", "desktop"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like "
     "Gecko) Version/17.1 Mobile/15E148 Safari/604.1", "0", "", "Safari", "17", "iOS", "mobile"),
    ("Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) "
     "Version/17.1 Safari/605.1.15", "0", "", "Safari", "17", "macOS", "desktop"),
    ("Mozilla/5.0 (Linux; Android 13; SM-T870) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/119.0.0.0 Safari/537.36", "0", "", "Chrome", "119", "Android", "tablet"),
    ("Mozilla/5.0 (Linux; Android 13; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) "
     "Chrome/119.0.0.0 Mobile Safari/537.36", "0", "", "Chrome", "119", "Android", "mobile"),
    ("Mozilla/5.0 (Windows NT 10.0; Trident/7.0; rv:11.0) like Gecko", "0", "",
     "Internet Explorer", "11", "Windows", "desktop"),
    ("Mozilla/5.0 (PlayStation 5/8.0) AppleWebKit/605.1.15", "0", "", "", "", "PlayStation", "console"),
    ("Mozilla/5.0 (Web0S; Linux/SmartTV) AppleWebKit/537.36 Chrome/79.0.0.0 Safari/537.36", "0", "",
     "Chrome", "79", "webOS", "smarttv"),
    ("MyNewCrawler/2.0", "1", "MyNewCrawler", "", "", "", "unknown"),
    ("Mozilla/5.0 (Linux; Android 9; CUBOT X19) Chrome/80.0 Mobile", "0", "", "Chrome", "80",
     "Android", "mobile"),
]


def test_agent_cases(spark):
    for row, case in zip(agents(spark, *[c[0] for c in AGENT_CASES]), AGENT_CASES):
        got = tuple(row[k] for k in ("bot", "name", "browser", "version", "os", "device"))
        assert got == case[1:], case[0]


def test_tags(spark):
    columns = {
        "Hostname": "_hostname", "Environment": "_environment", "Service": "_service",
        "MyTag": "_extra.my_tag", "Missing": "_extra.none", "Odd": "_odd", "RemoteAddr": "remote_addr",
    }
    rows = spark.createDataFrame([("10.0.0.1",)], "remote_addr string")
    tags = Tags("web-02", "production", "api-gateway", {"my_tag": "us-east-1"})
    mapped = map_columns(rows, columns, tags)
    assert mapped.columns == sorted(columns)
    assert tuple(mapped.first()) == ("production", "web-02", "", "us-east-1", "", "10.0.0.1", "api-gateway")
    auto = map_columns(rows, {"h": "_hostname"}, Tags("auto")).first().h
    assert auto == socket.gethostname()


def test_missing_fields(spark):
    rows = spark.createDataFrame([("x",)], "remote_addr string")
    mapped = map_columns(rows, {"A": "remote_addr", "B": "nope", "C": "status"}, bad=True).first()
    assert (mapped.A, mapped.B, mapped.C, mapped._bad_fields) == ("x", "", None, ["status"])
    assert map_columns(rows, {}) is rows
