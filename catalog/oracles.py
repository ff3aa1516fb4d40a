"""Expected results as SQL over the given tables; computed from columns, never from log lines."""

from __future__ import annotations

from catalog.fixture import AGENTS, REFERERS

ORACLES: dict[str, str] = {}

SPAN = "t BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-01-31 23:59:59'"


def _texts(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_HOSTS = ["", "example.com", "example.com", "sub.domain.org", "", "a_b.test"]
# What each of the sample user agents is.
_AGENT_FACTS = {
    "c10_is_bot": ["1", "1", "1", "1", "0", "0", "0", "0", "1", "1", "1", "1", "1", "1"],
    "c11_bot_name": ["Googlebot", "bingbot", "curl", "Wget", "", "", "", "", "AhrefsBot", "GPTBot",
                     "ClaudeBot", "SemrushBot", "facebookexternalhit", "WhatsApp"],
    "c12_bot_class": ["search", "search", "scraper", "scraper", "", "", "", "", "seo-tool", "ai",
                      "ai", "seo-tool", "social", "social"],
    "c13_browser": ["", "", "", "", "Chrome", "Firefox", *[""] * 8],
    "c14_browser_version": ["", "", "", "", "120", "121", *[""] * 8],
    "c15_os": ["", "", "", "", "Linux", "Windows", *[""] * 8],
    "c16_device_type": [*["unknown"] * 4, "desktop", "desktop", *["unknown"] * 8],
}

# One row per event: the request it stands for. ``good`` marks the lines that parse.
BASE = f"""
WITH e AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         CAST(floor(value * 10) AS BIGINT) AS ms
  FROM events
), u AS (
  SELECT *,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'POST'
         WHEN event_type = 'error' AND k % 5 = 0 THEN 'DELETE' ELSE 'GET' END AS verb,
    CASE WHEN event_id % 20 = 0 THEN '/healthz'
         ELSE concat('/', event_type, '/', k,
                     {_texts(['.html', '.js?v=1.2', '.css#top', '.PNG', '', '/'])}[k % 6 + 1])
    END AS target
  FROM e
), r AS (
  SELECT event_id, ts, k, user_id, event_id % 101 <> 0 AS good,
    concat('10.', CAST(floor(user_id / 256) AS BIGINT) % 256, '.', user_id % 256, '.1') AS addr,
    CASE WHEN event_type IN ('purchase', 'signup') THEN concat('user', user_id) ELSE '-' END AS usr,
    date_trunc('second', ts) AS t,
    strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0700' AS logged,
    CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN verb
         ELSE concat(verb, ' ', target, ' HTTP/1.1') END AS request,
    CASE WHEN event_id % 97 = 0 THEN '' ELSE verb END AS method,
    CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 THEN '' ELSE target END AS url,
    CASE WHEN event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 20 = 0 THEN ''
         ELSE ['html', 'js', 'css', 'png', '', ''][k % 6 + 1] END AS ext,
    CAST(CASE WHEN event_type = 'error' THEN CASE WHEN k % 2 = 0 THEN 500 ELSE 404 END
         WHEN event_type = 'signup' THEN 201 WHEN event_type = 'click' THEN 302
         WHEN event_type = 'view' AND k % 10 = 0 THEN 304 ELSE 200 END AS INTEGER) AS status,
    CAST(floor(value * 100) AS BIGINT) AS bytes,
    concat(CAST(floor(ms / 1000) AS BIGINT), '.', lpad(CAST(ms % 1000 AS VARCHAR), 3, '0'))
      AS took_text,
    ms / 1000.0::DOUBLE AS took,
    {_texts(REFERERS)}[user_id % 6 + 1] AS referer,
    {_texts(_HOSTS)}[user_id % 6 + 1] AS host,
    {_texts(AGENTS)}[event_id % 14 + 1] AS agent
  FROM u
), lines AS (
  SELECT *, CASE WHEN NOT good THEN concat('corrupt ', event_id) ELSE concat(
      addr, ' - ', usr, ' [', logged, '] "', request, '" ', status, ' ', bytes, ' "', referer,
      '" "', agent, '" ', took_text) END AS line
  FROM r
), g AS (SELECT * FROM lines WHERE good), w AS (SELECT * FROM g WHERE {SPAN})
"""

ROW = """addr AS "RemoteAddr", usr AS "RemoteUser", t AS "TimeLocal", request AS "Request",
  status AS "Status", bytes AS "BytesSent", referer AS "HttpReferer", agent AS "HttpUserAgent",
  round(took, 10) AS "RequestTime\""""
DATED = ROW + ', CAST(t AS DATE) AS "Date"'


def expect(name: str, select: str) -> None:
    ORACLES[name] = f"{BASE}\n{select}"


# A
expect("a1_read_logs", "SELECT line AS value FROM lines")
expect("a2_stream_logs", "SELECT line AS value FROM lines")
expect("a3_tail", "SELECT line AS value FROM lines")
expect("a4_start_position", "SELECT line AS value FROM lines WHERE ts >= TIMESTAMP '2024-01-16'")
expect(
    "a5_normalise",
    """SELECT event_id, CASE WHEN event_id % 5000 = 1 THEN concat(line, repeat('y', 1100000))
      ELSE line END AS value FROM lines""",
)

# B
expect(
    "b1_long_lines",
    """SELECT event_id, CAST(length(addr) + CASE WHEN event_id % 1000 = 3 THEN 1200000 ELSE 0 END AS INTEGER)
      AS size, took_text AS request_time FROM g""",
)
_FIELDS = """event_id, addr AS remote_addr, usr AS remote_user, logged AS time_local, request,
  CAST(status AS VARCHAR) AS status, CAST(bytes AS VARCHAR) AS bytes_sent,
  referer AS http_referer, agent AS http_user_agent"""
expect("b1_parse_text", f"SELECT {_FIELDS}, took_text AS request_time FROM g")
expect(
    "b2_parse_json",
    # A JSON number keeps no trailing zeros.
    f"SELECT {_FIELDS}, regexp_replace(took_text, '\\.?0+$', '') AS request_time FROM g",
)
expect(
    "b3_json_scalars",
    """SELECT event_id, CAST(k AS VARCHAR) AS i, CAST(k AS VARCHAR) AS z, concat(k, '.5') AS f,
      CAST(k * 100 AS VARCHAR) AS e,
      CASE WHEN k = 0 THEN '0' ELSE regexp_replace(concat('0.', lpad(CAST(k AS VARCHAR), 7, '0')),
        '0+$', '') END AS m,
      CASE WHEN k = 0 THEN '0' ELSE concat(k, repeat('0', 20)) END AS x,
      CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS b, '' AS n,
      concat(k, '.00') AS s, concat('{"a":"\\u003c\\u0026","y":', k, '}') AS o,
      CAST(NULL AS VARCHAR) AS absent
    FROM r""",
)
expect(
    "b4_parse_errors",
    """SELECT line AS value, 'line does not match the log format' AS error
    FROM lines WHERE NOT good""",
)
expect(
    "b5_typed_fields",
    """SELECT event_id, addr AS remote_addr,
      CASE WHEN event_id % 50 <> 0 THEN status END AS status,
      CASE WHEN event_id % 60 <> 0 THEN bytes END AS bytes_sent,
      CASE WHEN event_id % 70 <> 0 THEN t END AS time_local,
      CASE WHEN event_id % 80 <> 0 THEN round(took, 10) END AS request_time,
      concat_ws(',', CASE WHEN event_id % 70 = 0 THEN 'time_local' END,
        CASE WHEN event_id % 50 = 0 THEN 'status' END,
        CASE WHEN event_id % 60 = 0 THEN 'bytes_sent' END,
        CASE WHEN event_id % 80 = 0 THEN 'request_time' END)
        AS bad_fields
    FROM g""",
)
expect(
    "b6_blank_lines",
    """SELECT event_id % 10 = 0 AS blank,
      CASE WHEN event_id % 10 = 0 OR NOT good THEN 'line does not match the log format' END
        AS error, count(*) AS cnt
    FROM lines GROUP BY 1, 2""",
)

# C
expect("c01_map_columns", f"SELECT {ROW} FROM g")
expect(
    "c02_missing_field",
    """SELECT event_id, CAST(NULL AS BIGINT) AS "Connection", '' AS "Server",
      status AS "Status", 'connection' AS bad_fields FROM g""",
)
for _name, _value in {
    "c03_hostname": "'web-02'",
    "c04_environment": "'production'",
    "c05_service": "'api-gateway'",
    "c06_extra": "'us-east-1'",
    "c06_extra_missing": "''",
    "c07_status_class": "concat(status // 100, 'xx')",
    "c08_referrer_domain": "host",
    "c09_url_extension": "ext",
    "c17_unknown_source": "''",
    **{name: f"{_texts(facts)}[event_id % 14 + 1]" for name, facts in _AGENT_FACTS.items()},
}.items():
    _value = f"CAST({_value} AS INTEGER)" if _name == "c10_is_bot" else _value
    expect(_name, f"SELECT event_id, {_value} AS value FROM g")
expect("c03_hostname_by_file", """SELECT request AS "Request", concat('web-', event_id % 3) AS "Hostname" FROM g""")
_FACT = {name: f"{_texts(facts)}[event_id % 14 + 1]" for name, facts in _AGENT_FACTS.items()}
FULL = f"""{ROW}, 'web-02' AS "Hostname", 'production' AS "Environment", 'api-gateway' AS "Service",
  concat(status // 100, 'xx') AS "StatusClass", host AS "RefererDomain", ext AS "UrlExtension",
  CAST({_FACT['c10_is_bot']} AS INTEGER) AS "IsBot", {_FACT['c11_bot_name']} AS "BotName",
  {_FACT['c12_bot_class']} AS "BotClass", {_FACT['c13_browser']} AS "Browser",
  {_FACT['c14_browser_version']} AS "BrowserVersion", {_FACT['c15_os']} AS "OS",
  {_FACT['c16_device_type']} AS "DeviceType\""""
expect("c18_full_row", f"SELECT {FULL} FROM g")
expect("c18_full_row_json", f"SELECT {FULL} FROM g")
expect("h1_stream_json", f"SELECT {FULL} FROM g WHERE NOT contains(request, '/healthz')")
expect(
    "d05_streamed_twice",
    """SELECT true AS sampled, count(*) FILTER (status >= 400) AS errors, CAST(0 AS BIGINT) AS in_one_only FROM g""",
)
expect(
    "d05_equal_lines",
    """SELECT way, count(*) > 0 AS fair, true AS same_again
    FROM lines, unnest(['batch keep', 'batch drop', 'landing keep', 'tail keep']) AS w(way) GROUP BY way""",
)
expect(
    "c07_status_class_raw",
    """SELECT event_id, CASE WHEN left(CAST(k AS VARCHAR), 1) BETWEEN '1' AND '5'
      THEN concat(left(CAST(k AS VARCHAR), 1), 'xx') ELSE '' END AS value FROM r""",
)
ORACLES["c08_page_host"] = (
    "SELECT page_id, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host FROM pages"
)
ORACLES["c09_page_extension"] = r"""
SELECT page_id, lower(regexp_extract(
    regexp_extract(regexp_extract(url, '^https?://[^/]+(.*)$', 1), '^[^?#]*'),
    '\.([^./]*)$', 1)) AS extension FROM pages"""

# D
_KEPT = "SELECT event_id, CAST(status AS VARCHAR) AS status, request FROM g WHERE "


def _drawn(rate: float, salt: str) -> str:
    salt = salt.replace("'", "''")
    first = f"CAST('0x' || substr(md5(concat(event_id, '{salt}')), 1, 8) AS BIGINT)"
    return f"{first} < {int(rate * 2**32)}"


expect("d01_drop", _KEPT + "NOT (status >= 200 AND status < 300)")
expect("d02_keep", _KEPT + "status >= 500")
expect("d03_sampled_drop", _KEPT + f"NOT (status < 400 AND {_drawn(0.9, '|0|status < 400')})")
expect("d04_sampled_keep", _KEPT + f"status < 400 AND {_drawn(0.25, '|0|status < 400')}")
expect("d05_sampler", f"SELECT event_id FROM r WHERE {_drawn(0.3, '|salt')}")
expect(
    "d06_ordered_chain",
    _KEPT + "status >= 404 AND NOT contains(request, 'POST') AND NOT took > 0.2",
)
expect(
    "d07_numeric_coercion",
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'abc' ELSE CAST(status AS VARCHAR) END
      AS status, request FROM g WHERE event_id % 7 = 0 OR bytes = 0""",
)
expect(
    "d08_predicates",
    _KEPT + """NOT regexp_matches(request, '^GET /health') AND contains(request, '.html')
      OR agent = 'curl/7.68.0'""",
)
expect("d09_rule_validation", "SELECT event_id, 1 AS accepted FROM g WHERE NOT status >= 500")
expect("d10_fail_open", _KEPT + "status = 200 OR bytes / (status - 200) > 10")

# E
expect("e1_append", f"SELECT {DATED} FROM g")
expect(
    "e2_cadence",
    """SELECT count(*) AS lines_read, count(*) FILTER (NOT good) AS parse_errors,
      count(*) FILTER (good) AS lines_processed, count(*) FILTER (good) AS lines_stored,
      count(DISTINCT floor(epoch(ts) / 25200)) AS batches FROM lines""",
)
expect(
    "e3_replay",
    """SELECT CAST(202401 AS INTEGER) AS month,
        CAST(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS INTEGER) AS batch_id,
        count(*) AS cnt FROM g GROUP BY 2
      UNION ALL SELECT 202401, -1, count(*) FROM g WHERE ts < TIMESTAMP '2024-01-16'""",
)
expect("e4_months", "SELECT CAST(year(t) * 100 + month(t) AS INTEGER) AS month, count(*) AS cnt FROM g GROUP BY 1")
expect(
    "e5_range_layout",
    """SELECT count(*) AS stored, CAST(0 AS BIGINT) AS out_of_order, true AS several_files FROM g
      WHERE t >= TIMESTAMP '2024-01-01' AND t < TIMESTAMP '2024-02-01'""",
)
expect(
    "e7_contract",
    # Nine columns are there, the tenth is not.
    """SELECT name, name <> 'Columns' OR message LIKE 'OK%' AS ok, message FROM (VALUES
      ('Catalog', 'OK (spark_catalog)'), ('Database', 'OK default'), ('Table', 'OK stored_requests'),
      ('Columns', 'OK found 9, missing 0, derived 0'),
      ('Catalog', 'OK (spark_catalog)'), ('Database', 'OK default'), ('Table', 'OK stored_requests'),
      ('Columns', 'FAIL found 9, missing 1 (StatusClass), derived 1')) v(name, message)""",
)
expect("e6_date", "SELECT CAST(t AS DATE) AS day, count(*) AS cnt FROM g GROUP BY 1")
expect(
    "e8_unexpired",
    """SELECT CAST(t AS DATE) AS day, count(*) AS cnt FROM g
      WHERE t > TIMESTAMP '2024-07-13' - INTERVAL 180 DAY GROUP BY 1""",
)
expect(
    "e8_expire",
    # The cutoff is 17 December: November goes, December stays whole.
    """SELECT CAST(year(m) * 100 + month(m) AS INTEGER) AS month, count(*) AS cnt
      FROM (SELECT CASE WHEN status < 300 THEN t - INTERVAL 62 DAY ELSE t END AS m FROM g)
      WHERE m >= TIMESTAMP '2023-12-01' GROUP BY 1""",
)

expect(
    "e5_crashed_layout",
    "SELECT step, count(*) AS stored FROM g, unnest(['crashed', 'again']) AS s(step) GROUP BY step",
)
expect(
    "e3_readers",
    """SELECT reader, count(*) FILTER ((ts < TIMESTAMP '2024-01-16') = (reader = 'before')) AS stored
      FROM g, unnest(['before', 'after', 'removed']) AS s(reader) GROUP BY reader""",
)
expect(
    "e8_without_a_time",
    """SELECT step, count(*) FILTER (step = 'kept') AS stored
      FROM g, unnest(['kept', 'expired']) AS s(step) GROUP BY step""",
)

# F
expect(
    "f00_default_range",
    """SELECT count(*) AS cnt, max(t) AS newest, true AS one_month_read FROM g
      WHERE t >= (SELECT max(t) FROM g) - INTERVAL 1 DAY""",
)
expect(
    "f00_time_range",
    """SELECT t AS "TimeLocal", addr AS "RemoteAddr", request AS "Request" FROM g
      WHERE t BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-09 12:00:00'""",
)
expect(
    "f00_stored_range",
    """SELECT count(*) AS total FROM g
      WHERE t BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-09 12:00:00'""",
)
expect("f01_total_requests", "SELECT count(*) AS total FROM w")
expect(
    "f02_average_rps",
    """SELECT round(count(*) / greatest(date_diff('second', min(t), max(t)), 1), 10) AS rps FROM w""",
)
_FAILED = "count(*) FILTER (status >= 500) * 100.0::DOUBLE / greatest(count(*), 1)"
_WRONG = "count(*) FILTER (status >= 400) * 100.0::DOUBLE / greatest(count(*), 1)"
_P95, _P99 = "quantile_cont(took, 0.95)", "quantile_cont(took, 0.99)"
expect("f03_error_rate", f"SELECT round({_FAILED}, 10) AS error_rate FROM w")
expect("f04_mean_response_time", "SELECT round(avg(took), 10) AS avg_time FROM w")
expect("f05_p95", f"SELECT round({_P95}, 10) AS p95 FROM w")
expect("f06_p99", f"SELECT round({_P99}, 10) AS p99 FROM w")
_CLASSES = """SELECT date_trunc('hour', t) AS time, concat(status // 100, 'xx') AS status_class,
  count(*) AS cnt FROM w GROUP BY 1, 2"""
expect("f07_status_class_series", _CLASSES)
expect("flagship", _CLASSES)
expect("f08_by_method", "SELECT method, count(*) AS cnt FROM w GROUP BY 1")
_HOURS = "FROM w GROUP BY 1"
_LATENCY = f"""SELECT date_trunc('hour', t) AS time, avg(took) AS avg, {_P95} AS p95,
  {_P99} AS p99 {_HOURS}"""
_ERRORS = f"""SELECT date_trunc('hour', t) AS time, {_WRONG} AS error_4xx_5xx,
  {_FAILED} AS error_5xx {_HOURS}"""
_BYTES = f"SELECT date_trunc('hour', t) AS time, CAST(sum(bytes) AS BIGINT) AS bytes_sent {_HOURS}"
_RPS = f"SELECT date_trunc('hour', t) AS time, count(*) / 3600.0::DOUBLE AS rps {_HOURS}"
expect(
    "f09_latency_series",
    f"""SELECT time, round(avg, 10) AS avg, round(p95, 10) AS p95, round(p99, 10) AS p99
    FROM ({_LATENCY})""",
)
expect(
    "f10_error_rate_series",
    f"""SELECT time, round(error_4xx_5xx, 10) AS error_4xx_5xx, round(error_5xx, 10) AS error_5xx
    FROM ({_ERRORS})""",
)
expect("f11_bandwidth_series", _BYTES)
expect("f12_rps_series", f"SELECT time, round(rps, 10) AS rps FROM ({_RPS})")
for _name, _key, _column in (
    ("f13_top_urls", "url", "url"),
    ("f14_top_clients", "addr", "ip"),
    ("f15_top_agents", "agent", "ua"),
):
    expect(
        _name,
        f"""SELECT {_key} AS {_column}, count(*) AS cnt FROM w GROUP BY 1
        ORDER BY cnt DESC, 1 LIMIT 10""",
    )
    ORACLES[_name] = f"""SELECT *, CAST(row_number() OVER (ORDER BY cnt DESC, {_column}) AS INTEGER) AS rank
      FROM ({ORACLES[_name]})"""
_DETAIL = """SELECT t AS "TimeLocal", addr AS "RemoteAddr", method AS "Method", url AS "URL",
  status AS "Status", bytes AS "BytesSent", round(took, 10) AS "RequestTime",
  referer AS "HttpReferer", agent AS "HttpUserAgent" FROM w WHERE status >= 400 OR took > 1
  ORDER BY t DESC, 2, 3, 4, 5, 6, 7, 8, 9 LIMIT 500"""
_BY = ", ".join(f'"{name}"' for name in (
    "RemoteAddr", "Method", "URL", "Status", "BytesSent", "RequestTime", "HttpReferer", "HttpUserAgent"))
_PLACED = f"""SELECT *, CAST(row_number() OVER (ORDER BY "TimeLocal" DESC, {_BY}) AS INTEGER) AS rank
  FROM ({_DETAIL})"""
expect("f16_slow_or_failed", _PLACED)
expect(
    "f21_slowest_first",
    f"""SELECT * EXCLUDE (rank),
      CAST(row_number() OVER (ORDER BY "RequestTime" DESC, rank) AS INTEGER) AS rank FROM ({_PLACED})""",
)
expect(
    "f06_p99_sketch", "SELECT count(*) AS requests, true AS close FROM w WHERE took IS NOT NULL"
)
expect(
    "f05_crowded_cell",
    """SELECT round(quantile_cont(1.7e9::DOUBLE + event_id / 1000.0::DOUBLE, 0.5), 3) AS p50,
      round(quantile_cont(1.7e9::DOUBLE + event_id / 1000.0::DOUBLE, 0.95), 3) AS p95 FROM e""",
)
expect(
    "f17_buckets",
    """SELECT time_bucket(INTERVAL '15 minutes', t) AS time,
      round(count(*) / 900.0::DOUBLE, 10) AS rps FROM w GROUP BY 1""",
)
expect(
    "f18_status_class_legend",
    "SELECT concat(status // 100, 'xx') AS series, count(*) AS sum FROM w GROUP BY 1",
)


def _legend(series: str, lines: list[str], calcs: dict[str, str], digits: int = 10) -> str:
    return " UNION ALL ".join(
        f"SELECT '{line}' AS series, "
        + ", ".join(f"round({call}(CAST({line} AS DOUBLE)), {digits}) AS {calc}"
                    for calc, call in calcs.items())
        + f" FROM ({series})"
        for line in lines
    )


_MEAN_MAX = {"mean": "avg", "max": "max"}
expect("f18_latency_legend", _legend(_LATENCY, ["avg", "p95", "p99"], _MEAN_MAX))
expect("f18_error_rate_legend", _legend(_ERRORS, ["error_4xx_5xx", "error_5xx"], _MEAN_MAX))
expect("f18_bandwidth_legend", _legend(_BYTES, ["bytes_sent"], {"sum": "sum", "mean": "avg"}, 6))
expect("f18_rps_legend", _legend(_RPS, ["rps"], _MEAN_MAX))
expect(
    "f19_method_share",
    """SELECT method, count(*) AS cnt,
      round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 10) AS percent FROM w GROUP BY 1""",
)
for _name, _number, _column, _yellow, _red in (
    ("f20_error_rate_level", _FAILED, "error_rate", 1, 5),
    ("f20_mean_level", "avg(took)", "avg_time", 0.5, 1),
    ("f20_p95_level", _P95, "p95", 1, 3),
    ("f20_p99_level", _P99, "p99", 3, 10),
):
    expect(
        _name,
        f"""SELECT round(x, 10) AS {_column}, CASE WHEN x >= {_red} THEN 'red'
          WHEN x >= {_yellow} THEN 'yellow' ELSE 'green' END AS level
        FROM (SELECT {_number} AS x FROM w)""",
    )

# G
expect(
    "g1_line_counters",
    """SELECT count(*) AS lines_read, count(*) FILTER (NOT good) AS parse_errors,
      count(*) FILTER (good AND contains(request, '/healthz')) AS lines_filtered,
      count(*) FILTER (good AND NOT contains(request, '/healthz')) AS lines_processed,
      CAST(0 AS BIGINT) AS lines_not_processed FROM lines""",
)
expect(
    "g2_reconciliation",
    """SELECT count(*) AS lines_read,
      count(*) FILTER (good AND NOT contains(request, '/healthz')) AS rows_stored, true AS balanced
    FROM lines""",
)
expect(
    "g4_flush_seconds",
    """SELECT CAST(11 AS BIGINT) AS bounds, true AS rising, count(DISTINCT floor(epoch(ts) / 864000)) AS batches
    FROM lines""",
)
expect(
    "g3_batch_sizes",
    """, b AS (SELECT count(*) FILTER (good AND NOT contains(request, '/healthz')) AS entries
      FROM lines GROUP BY floor(epoch(ts) / 259200))
    SELECT le, (SELECT count(*) FROM b WHERE le IS NULL OR entries <= le) AS observations
    FROM (VALUES (10.0::DOUBLE), (50), (100), (500), (1000), (5000), (10000), (NULL)) v(le)""",
)
_BOT = f"{_texts(_AGENT_FACTS['c10_is_bot'])}[event_id % 14 + 1] = '1'"
expect(
    "g5_bots",
    f"""SELECT count(*) FILTER ({_BOT}) AS bot_requests,
      count(DISTINCT agent) FILTER ({_BOT}) AS bot_agents FROM g""",
)
expect(
    "g6_agent_reuse",
    """SELECT count(*) - count(DISTINCT agent) AS hits, count(DISTINCT agent) AS misses,
      round((count(*) - count(DISTINCT agent)) / count(*), 10) AS hit_ratio
    FROM g WHERE agent NOT IN ('', '-')""",
)

# H
expect("h1_stream_ingest", f"SELECT {DATED} FROM g WHERE NOT contains(request, '/healthz')")
expect("h2_live_status_classes", _CLASSES)
expect(
    "h2_live_traffic",
    f"""SELECT date_trunc('hour', t) AS time, count(*) AS cnt, round(avg(took), 10) AS avg,
      round({_WRONG}, 10) AS error_4xx_5xx, round({_FAILED}, 10) AS error_5xx,
      CAST(sum(bytes) AS BIGINT) AS bytes_sent, round(count(*) / 3600.0::DOUBLE, 10) AS rps,
      true AS p95_close, true AS p99_close
    FROM w GROUP BY 1""",
)
expect(
    "h2_live_range",
    f"""SELECT *, true AS few_folders, true AS none_before FROM ({_CLASSES})
      WHERE time BETWEEN TIMESTAMP '2024-01-08' AND TIMESTAMP '2024-01-09 23:00:00'""",
)
ORACLES["h2_live_tops"] = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, {kind} AS key, cnt, rank, true AS sure FROM ({ORACLES[name]})"
    for kind, name in (("url", "f13_top_urls"), ("ip", "f14_top_clients"), ("ua", "f15_top_agents"))
)
ORACLES["g6_live_reuse"] = f"""SELECT hits + misses AS lookups, bot_requests, true AS agents_close, true AS bots_close
    FROM ({ORACLES["g6_agent_reuse"]}), ({ORACLES["g5_bots"]})"""
expect("h3_late_rows", "SELECT CAST(t AS DATE) AS day, count(*) AS cnt FROM g GROUP BY 1")
expect("h4_restart", f"SELECT {DATED} FROM g")
