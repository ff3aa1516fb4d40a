"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that count as white space around a line.
WHITE_SPACE = (
    "\t\n\v\f\r "
    "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trim_line(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE_SPACE))


def request_method(request: Column) -> Column:
    """First blank-separated part of a request line."""
    return F.substring_index(request, " ", 1)


def request_target(request: Column) -> Column:
    """Second blank-separated part of a request line; ``''`` when there is none."""
    second = F.substring_index(F.substring_index(request, " ", 2), " ", -1)
    return F.when(F.contains(request, F.lit(" ")), second).when(request.isNotNull(), "")


def status_class(status: Column) -> Column:
    """``4xx`` for ``404``: the leading digit of the raw text when it is 1 to 5, else ``''``."""
    raw = F.coalesce(status, F.lit(""))
    return F.when(raw.rlike("^[1-5]"), F.concat(F.substring(raw, 1, 1), F.lit("xx"))).otherwise("")
