"""Does a table exist and hold every configured column?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def check_table(
    spark: SparkSession, table: str, columns: dict[str, str], database: str | None = None
) -> DataFrame:
    """Rows (name, ok, message) for catalog, database, table and columns; stops at the first miss.

    Derived columns are counted apart and checked too, as the writer names them.
    """
    results = []

    def report(name: str, ok: bool, message: str) -> bool:
        results.append((name, ok, ("OK " if ok else "FAIL ") + message))
        return ok

    def done() -> DataFrame:
        return spark.createDataFrame(results, "name string, ok boolean, message string")

    catalog = spark.catalog.currentCatalog()
    report("Catalog", True, f"({catalog})")
    database = database or spark.catalog.currentDatabase()
    if not report("Database", spark.catalog.databaseExists(database), database):
        return done()
    full = table if spark.catalog.tableExists(table) else f"{database}.{table}"
    if not report("Table", spark.catalog.tableExists(full), full):
        return done()
    present = set(spark.table(full).columns)
    missing = sorted(name for name in columns if name not in present)
    derived = sum(source.startswith("_") for source in columns.values())
    found = len(columns) - len(missing)
    gone = f" ({', '.join(missing)})" if missing else ""
    report("Columns", not missing, f"found {found}, missing {len(missing)}{gone}, derived {derived}")
    return done()
