"""Typed fields in place of raw texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loglode.functions.typed import typed
from loglode.model import kind_of


def cast_fields(parsed: DataFrame, fields: list[str]) -> DataFrame:
    """Cast each field by its name and list in ``_bad_fields`` the texts that did not cast."""
    cast = parsed.select("*", *[typed(name, F.col(name)).alias(f"_typed_{name}") for name in fields])
    bad = bad_fields({name: (F.col(name), F.col(f"_typed_{name}")) for name in fields})
    return cast.select(
        *[F.col(f"_typed_{name}").alias(name) if name in fields else F.col(name)
          for name in parsed.columns],
        bad.alias("_bad_fields"),
    )


def bad_fields(pairs: dict[str, tuple[Column, Column]]) -> Column:
    """Names of the fields whose text is there but whose cast value is not, in the given order."""
    flags = [
        F.when(raw.isNotNull() & value.isNull(), F.lit(name))
        for name, (raw, value) in pairs.items()
        if kind_of(name) != "string"
    ]
    if not flags:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*flags))
