"""Lines to named text fields, and the split into good and bad lines."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

MARK, GAP = "\u0002", "\u0001"
PLACEHOLDER = re.compile(r"\$([A-Za-z0-9_]+)")

NO_MATCH = "line does not match the log format"
NOT_AN_OBJECT = "line is not a JSON object"


def compile_format(log_format: str) -> tuple[list[str], str]:
    """Field names and the pattern with one group per field.

    A field runs up to the first character of the text that follows it in the format, or up to
    the next blank when it is last. Text after the last field is allowed.
    """
    pieces = PLACEHOLDER.split(log_format)
    fields, literals = pieces[1::2], pieces[2::2]
    if not fields:
        raise ValueError(f"no $field in log format {log_format!r}")
    if len(set(fields)) < len(fields):
        raise ValueError(f"a field appears twice in log format {log_format!r}")
    if "" in literals[:-1]:
        raise ValueError(f"adjacent fields cannot be told apart in log format {log_format!r}")
    pattern = "^" + _quote(pieces[0])
    for literal in literals:
        stop = re.escape(literal[0] if literal else " ")
        pattern += f"([^{stop}]*){_quote(literal)}"
    return fields, pattern


def _quote(literal: str) -> str:
    return "".join("\\" + c if not c.isalnum() and ord(c) < 128 else c for c in literal)


def parse_text(lines: DataFrame, log_format: str, column: str = "value") -> DataFrame:
    """Add one string column per ``$field``, and ``_error`` (NULL for a good line)."""
    fields, pattern = compile_format(log_format)
    line = F.col(column)
    groups = "".join(f"{GAP}${i}" for i in range(1, len(fields) + 1))
    # One pass of the pattern cuts all fields at once. A line that already holds the cutting
    # character takes the field-by-field way.
    cut = F.split(F.regexp_replace(line, f"(?s){pattern}.*", MARK + groups), GAP)
    single = F.when(
        line.rlike(pattern),
        F.array(F.lit(MARK), *[F.regexp_extract(line, pattern, i + 1) for i in range(len(fields))]),
    )
    parts = F.when(F.contains(line, F.lit(GAP)), single).otherwise(cut)
    good = F.coalesce(F.get(F.col("_parts"), F.lit(0)) == MARK, F.lit(False))
    return once(lines, parts, "_parts").select(
        *lines.columns,
        *[F.when(good, F.get(F.col("_parts"), F.lit(i + 1))).alias(name)
          for i, name in enumerate(fields)],
        F.when(~good, NO_MATCH).alias("_error"),
    )


def once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column that is worked out once per row, however many filters follow.

    A filter on a plain column moves below it and repeats its work; it cannot move below a
    generator.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def split_valid(parsed: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good rows without ``_error``, and the quarantine of bad lines with their reason."""
    good = parsed.where(F.col("_error").isNull()).drop("_error")
    bad = parsed.where(F.col("_error").isNotNull()).select(column, "_error")
    return good, bad
