"""Source fields and derived values to table columns."""

from __future__ import annotations

import socket
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from loglode.functions.agents import AGENT_FIELDS, with_agent
from loglode.functions.text import status_class
from loglode.functions.typed import typed
from loglode.functions.urls import request_extension, url_host
from loglode.model import FILE, kind_of
from loglode.operators.typed import bad_fields


@dataclass(frozen=True)
class Tags:
    """What a run adds to every row.

    ``hostname="auto"`` is the name of the driver's host, which is right for one machine's own logs.
    ``host_pattern`` is a regular expression for the path of the log file, whose first group is the
    host; files it does not match get ``hostname``.
    """

    hostname: str = ""
    environment: str = ""
    service: str = ""
    extra: dict[str, str] = field(default_factory=dict)
    host_pattern: str | None = None

    def host(self) -> str:
        return socket.gethostname() if self.hostname == "auto" else self.hostname


def raw_field(parsed: DataFrame, name: str) -> Column:
    """A source field as text, NULL when the input has no such field."""
    if name in parsed.columns:
        return F.col(name).cast("string")
    return F.lit(None).cast("string")


def derived(parsed: DataFrame, source: str, tags: Tags) -> Column:
    """Value of a ``_`` source; an unknown one is ``''``."""
    if source == "_hostname":
        if tags.host_pattern is None or FILE not in parsed.columns:
            return F.lit(tags.host())
        found = F.regexp_extract(F.col(FILE), tags.host_pattern, 1)
        return F.when(found != "", found).otherwise(tags.host())
    if source == "_environment":
        return F.lit(tags.environment)
    if source == "_service":
        return F.lit(tags.service)
    if source == "_status_class":
        return status_class(raw_field(parsed, "status"))
    if source == "_referrer_domain":
        return url_host(raw_field(parsed, "http_referer"))
    if source == "_url_extension":
        return request_extension(raw_field(parsed, "request"))
    if source == "_is_bot":
        return F.col(source).cast("int")
    if source in AGENT_FIELDS:
        return F.col(source)  # added by map_columns
    if source.startswith("_extra."):
        return F.lit(tags.extra.get(source.removeprefix("_extra."), ""))
    return F.lit("")


def mapped(parsed: DataFrame, source: str, tags: Tags) -> Column:
    """One table column. A missing text is ``''``, a missing or malformed number is NULL."""
    if source.startswith("_"):
        return derived(parsed, source, tags)
    value = typed(source, raw_field(parsed, source))
    return F.coalesce(value, F.lit("")) if kind_of(source) == "string" else value


def map_columns(
    parsed: DataFrame,
    columns: dict[str, str],
    tags: Tags = Tags(),
    keep: tuple[str, ...] = (),
    bad: bool = False,
) -> DataFrame:
    """Table columns in name order from ``{column: source}``; an empty mapping changes nothing.

    ``keep`` carries input columns through. ``bad`` adds ``_bad_fields``, the mapped fields that
    are missing or do not cast.
    """
    if not columns:
        return parsed
    agent = sorted(set(AGENT_FIELDS) & set(columns.values()))
    if agent:
        text = raw_field(parsed, "http_user_agent")
        parsed = with_agent(parsed.withColumn("http_user_agent", text), "http_user_agent", agent)
    out = parsed.select(
        *keep,
        *[mapped(parsed, columns[name], tags).alias(name) for name in sorted(columns)],
        *([_raw_numbers(parsed, columns).alias("_raw")] if bad else []),
    )
    if not bad:
        return out
    pairs = {
        source: (F.col("_raw")[source], F.col(name))
        for name, source in sorted(columns.items(), key=lambda item: item[1])
        if kind_of(source) != "string"
    }
    return out.withColumn("_bad_fields", bad_fields(pairs)).drop("_raw")


def _raw_numbers(parsed: DataFrame, columns: dict[str, str]) -> Column:
    """The texts behind the typed columns, with ``''`` for a missing one."""
    sources = sorted({s for s in columns.values() if kind_of(s) != "string"})
    return F.struct(
        *[F.coalesce(raw_field(parsed, s), F.lit("")).alias(s) for s in sources]
        or [F.lit("").alias("none")]
    )
