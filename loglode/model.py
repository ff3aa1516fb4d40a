"""Field names, types and table layout shared by every operator."""

from __future__ import annotations

# The access-log template and the JSON keys that carry the same fields.
MAIN_FORMAT = (
    '$remote_addr - $remote_user [$time_local] "$request" '
    '$status $bytes_sent "$http_referer" "$http_user_agent"'
)

# How a source field is typed, decided by its name alone.
# Any name that is not listed is a string.
TIME_FIELDS = ["time_local"]
INT_FIELDS = [
    "bytes_sent",
    "connections_waiting",
    "connections_active",
    "status",
    "connection",
    "request_length",
    "body_bytes_sent",
]
FLOAT_FIELDS = [
    "request_time",
    "upstream_connect_time",
    "upstream_header_time",
    "upstream_response_time",
    "msec",
]

# Table column -> source field, for the eight fields of MAIN_FORMAT.
BASIC_COLUMNS = {
    "RemoteAddr": "remote_addr",
    "RemoteUser": "remote_user",
    "TimeLocal": "time_local",
    "Request": "request",
    "Status": "status",
    "BytesSent": "bytes_sent",
    "HttpReferer": "http_referer",
    "HttpUserAgent": "http_user_agent",
}

# The full table, with latency and every derived column.
FULL_COLUMNS = {
    **BASIC_COLUMNS,
    "RequestTime": "request_time",
    "Hostname": "_hostname",
    "Environment": "_environment",
    "Service": "_service",
    "StatusClass": "_status_class",
    "RefererDomain": "_referrer_domain",
    "UrlExtension": "_url_extension",
    "IsBot": "_is_bot",
    "BotName": "_bot_name",
    "BotClass": "_bot_class",
    "Browser": "_browser",
    "BrowserVersion": "_browser_version",
    "OS": "_os",
    "DeviceType": "_device_type",
}

RETENTION_DAYS = 180

#: Column of the sources that holds the path of a line's file.
FILE = "_file"
#: Its place there, different for every line of a file; and where the part begins that one task reads.
AT, BLOCK = "_at", "_block"


def kind_of(field: str) -> str:
    """``time``, ``int``, ``float`` or ``string``."""
    if field in TIME_FIELDS:
        return "time"
    if field in INT_FIELDS:
        return "int"
    if field in FLOAT_FIELDS:
        return "float"
    return "string"


def sql_type(field: str) -> str:
    """Spark SQL type of a source field once it is cast."""
    if field == "status":
        return "int"
    return {"time": "timestamp_ntz", "int": "bigint", "float": "double", "string": "string"}[
        kind_of(field)
    ]
