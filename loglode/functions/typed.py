"""Name-driven casts of raw log text. A text that does not cast becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from loglode.model import kind_of, sql_type

INT_TEXT = r"^[+-]?[0-9]+$"
FLOAT_TEXT = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
NAMED_FLOAT_TEXT = r"(?i)^(?:[+-]?inf(?:inity)?|nan)$"
TIME_TEXT = r"^[0-9]{2}/[A-Za-z]{3}/[0-9]{4}:[0-9]{2}:[0-9]{2}:[0-9]{2} [+-][0-9]{4}$"
# Month numbers by name.
MONTHS = {
    "jan": "01", "feb": "02", "mar": "03", "apr": "04", "may": "05", "jun": "06",
    "jul": "07", "aug": "08", "sep": "09", "oct": "10", "nov": "11", "dec": "12",
}


def int_text(raw: Column) -> Column:
    """Whole decimal integers only: no blanks, no fraction, no overflow."""
    return F.when(raw.rlike(INT_TEXT), raw.try_cast("bigint"))


def float_text(raw: Column) -> Column:
    """Plain or scientific decimals; a finite text that overflows is rejected."""
    number = raw.try_cast("double")
    finite = raw.rlike(FLOAT_TEXT) & (F.abs(number) < F.lit(float("inf")))
    return F.when(finite | raw.rlike(NAMED_FLOAT_TEXT), number)


def wall_clock(raw: Column) -> Column:
    """``10/Oct/2000:13:55:36 -0700`` -> 2000-10-10 13:55:36, as logged.

    The offset is checked and dropped, never applied, and the session time zone plays no role.
    """
    spelled = {case(name): number for name, number in MONTHS.items()
               for case in (str.title, str.lower, str.upper)}
    months = F.create_map(*[F.lit(text) for pair in spelled.items() for text in pair])
    month = F.try_element_at(months, F.substring(raw, 4, 3))
    iso = F.concat(
        F.substring(raw, 8, 4), F.lit("-"), month, F.lit("-"), F.substring(raw, 1, 2),
        F.lit(" "), F.substring(raw, 13, 8),
    )
    return F.when(raw.rlike(TIME_TEXT), iso.try_cast("timestamp_ntz"))


def typed(field: str, raw: Column) -> Column:
    """The raw text of ``field`` in the type its name calls for."""
    kind = kind_of(field)
    if kind == "time":
        return wall_clock(raw)
    if kind == "int":
        return int_text(raw).try_cast(sql_type(field))
    if kind == "float":
        return float_text(raw)
    return raw


def rule_value(field: str, raw: Column) -> Column:
    """What a filter rule sees: numbers fall back to zero, texts to ``''``; never NULL."""
    kind = kind_of(field)
    if kind == "int":
        return F.coalesce(int_text(raw), F.lit(0).cast("bigint"))
    if kind == "float":
        return F.coalesce(float_text(raw), F.lit(0.0))
    return F.coalesce(raw, F.lit(""))
