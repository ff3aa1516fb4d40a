"""Runs a query and its SQL on the same tables and tells where they differ."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def expected(sf_dir: str, sql: str) -> tuple[dict[str, str], list[tuple]]:
    database = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = database.execute(sql)
    return {column[0]: str(column[1]) for column in found.description}, found.fetchall()


def canonical(columns: list[str], rows: list[tuple]) -> list[str]:
    """Rows as texts, columns in name order, in a fixed order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value) -> str:
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value + 0.0)
        return repr(value)

    return sorted("|".join(text(row[i]) for i in order) for row in rows)


def differences(frame, sf_dir: str, sql: str) -> str:
    """Empty when the frame holds exactly the rows the SQL gives."""
    types, rows = expected(sf_dir, sql)
    columns = list(types)
    got_types = {name: TYPES.get(kind, kind) for name, kind in frame.dtypes}
    if got_types != types:
        return f"columns {got_types} instead of {types}"
    got = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    want = canonical(columns, rows)
    if got == want:
        return ""
    extra = [row for row in got if row not in set(want)][:3]
    lost = [row for row in want if row not in set(got)][:3]
    return f"{len(got)} rows instead of {len(want)}; extra {extra}; missing {lost}"
