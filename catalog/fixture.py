"""Access-log lines rendered from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from loglode.model import MAIN_FORMAT

LINE_FORMAT = MAIN_FORMAT + " $request_time"
LINE_FIELDS = [
    "remote_addr", "remote_user", "time_local", "request", "status", "bytes_sent",
    "http_referer", "http_user_agent", "request_time",
]

# Sample texts, taken by user_id % 6 and event_id % 14.
REFERERS = [
    "-",
    "https://example.com/page?q=1",
    "https://example.com:8080/page",
    "http://sub.domain.org/path",
    "/local/path",
    "http://a_b.test/x",
]
AGENTS = [
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)",
    "Mozilla/5.0 (compatible; bingbot/2.0; +http://www.bing.com/bingbot.htm)",
    "curl/7.68.0",
    "Wget/1.20.3",
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; rv:121.0) Gecko/20100101 Firefox/121.0",
    "",
    "-",
    "Mozilla/5.0 (compatible; AhrefsBot/7.0; +http://ahrefs.com/robot/)",
    "Mozilla/5.0 AppleWebKit/537.36 (KHTML, like Gecko; compatible; GPTBot/1.0; "
    "+https://openai.com/gptbot)",
    "ClaudeBot/1.0",
    "Mozilla/5.0 (compatible; SemrushBot/7; +http://www.semrush.com/bot.html)",
    "facebookexternalhit/1.1 (+http://www.facebook.com/externalhit_uatext.php)",
    "WhatsApp/2.23.20.0",
]
PATH_ENDS = [".html", ".js?v=1.2", ".css#top", ".PNG", "", "/"]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _pick(texts: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(t) for t in texts]), index.cast("int"))


def raw_fields(events: DataFrame) -> DataFrame:
    """``event_id`` and the nine raw texts of each request."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    ms = F.floor(F.col("value") * 10).cast("bigint")
    kind, user, event = F.col("event_type"), F.col("user_id"), F.col("event_id")
    text = lambda c: c.cast("string")
    method = (
        F.when(kind.isin("purchase", "signup"), "POST")
        .when((kind == "error") & (k % 5 == 0), "DELETE")
        .otherwise("GET")
    )
    url = F.when(event % 20 == 0, "/healthz").otherwise(
        F.concat(F.lit("/"), kind, F.lit("/"), text(k), _pick(PATH_ENDS, k % 6))
    )
    return events.select(
        "event_id",
        F.concat(
            F.lit("10."), text(F.floor(user / 256).cast("bigint") % 256),
            F.lit("."), text(user % 256), F.lit(".1"),
        ).alias("remote_addr"),
        F.when(kind.isin("purchase", "signup"), F.concat(F.lit("user"), text(user)))
        .otherwise("-").alias("remote_user"),
        F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" -0700")).alias("time_local"),
        F.when(event % 97 == 0, "")
        .when(event % 89 == 0, method)
        .otherwise(F.concat(method, F.lit(" "), url, F.lit(" HTTP/1.1"))).alias("request"),
        F.when(kind == "error", F.when(k % 2 == 0, "500").otherwise("404"))
        .when(kind == "signup", "201")
        .when(kind == "click", "302")
        .when((kind == "view") & (k % 10 == 0), "304")
        .otherwise("200").alias("status"),
        text(F.floor(F.col("value") * 100).cast("bigint")).alias("bytes_sent"),
        _pick(REFERERS, user % 6).alias("http_referer"),
        _pick(AGENTS, event % 14).alias("http_user_agent"),
        F.concat(
            text(F.floor(ms / 1000).cast("bigint")), F.lit("."), F.lpad(text(ms % 1000), 3, "0")
        ).alias("request_time"),
    )


def _rendered(events: DataFrame, good: Column) -> DataFrame:
    event = F.col("event_id")
    corrupt = F.concat(F.lit("corrupt "), event.cast("string"))
    return raw_fields(events).select(
        "event_id", F.when(event % 101 == 0, corrupt).otherwise(good).alias("value")
    )


def text_lines(events: DataFrame) -> DataFrame:
    """``event_id`` and one text line per event; one in 101 is corrupt."""
    quoted = lambda name: F.concat(F.lit('"'), F.col(name), F.lit('"'))
    return _rendered(
        events,
        F.concat(
            "remote_addr", F.lit(" - "), "remote_user", F.lit(" ["), "time_local", F.lit("] "),
            quoted("request"), F.lit(" "), "status", F.lit(" "), "bytes_sent", F.lit(" "),
            quoted("http_referer"), F.lit(" "), quoted("http_user_agent"),
            F.lit(" "), "request_time",
        ),
    )


def json_lines(events: DataFrame) -> DataFrame:
    """The same requests as JSON objects; status, bytes_sent and request_time are numbers."""
    numbers = ("status", "bytes_sent", "request_time")
    members = []
    for name in LINE_FIELDS:
        quote = "" if name in numbers else '"'
        members += [F.lit(f'"{name}":{quote}'), F.col(name), F.lit(quote + ",")]
    members[-1] = F.lit("}")
    return _rendered(events, F.concat(F.lit("{"), *members))
