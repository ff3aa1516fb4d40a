"""Shared helpers: stored intermediate tables, row numbers and joins that check sizes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from loglode.session import fresh_dir

#: Largest key table that is sent to every executor, in rows of a few longs each (some 64 MB).
BROADCAST_ROWS = 2_000_000
#: Bytes of rows that go to a Python worker at once: the JVM holds them twice outside its heap.
ARROW_BYTES, ARROW_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
#: A word: a run without space, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once below the shared folder, and read from there.

    Cuts the lineage: a lost executor costs a read of the table, not the work before it.
    """
    spark = frame.sparkSession
    path = fresh_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """What is run meanwhile sends rows to Python workers in batches of a few MB; the setting is set back at once."""
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.set(ARROW_BYTES, str(ARROW_BATCH))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


def wider(frame: DataFrame, **kinds: str) -> StructType:
    """The frame's schema with more columns at its end."""
    schema = StructType(list(frame.schema.fields))
    for name, kind in kinds.items():
        schema.add(name, kind)
    return schema


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def sized(keys: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The frame marked for broadcast if it is no longer than ``limit`` rows, else as it is."""
    few = keys.limit(limit + 1).count() <= limit
    return F.broadcast(keys) if few else keys


def numbered(frame: DataFrame, order: list[str], number: str) -> DataFrame:
    """Add the place of each row, from 0, in the ascending order of some columns.

    Rows are cut into ranges and sorted there; the row counts of the ranges, one row per range,
    give each range its first number.
    """
    place = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranged = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stored(ranged.withColumn(number, F.monotonically_increasing_id()), "numbered")
    kept = kept.withColumn("range", F.shiftright(number, 33))
    first = (
        kept.groupBy("range")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select("range", F.coalesce(F.sum("rows").over(place), F.lit(0)).alias("first"))
    )
    in_range = F.col(number).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        kept.join(F.broadcast(first), "range")
        .withColumn(number, F.col("first") + in_range)
        .drop("range", "first")
    )


def one_row_each(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """For each row of ``keys`` (doc_id, text_sha256 of the lower-cased text) one row of ``docs``.

    Keys are different from each other; a null doc_id is a value like any other. Only rows that
    repeat id and text are grouped, in a frame of their own.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    mark = [docs.doc_id.eqNullSafe(keys.doc_id), F.sha2(ascii_lower(text), 256) == keys.text_sha256]
    again = stored(
        docs.select("doc_id", F.sha2(ascii_lower(text), 256).alias("text_sha256"))
        .groupBy("doc_id", "text_sha256")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select("doc_id", "text_sha256"),
        "again",
    )
    found = docs.join(keys, mark, "left_semi")
    if again.isEmpty():
        return found
    row = [docs.doc_id.eqNullSafe(again.doc_id), F.sha2(ascii_lower(text), 256) == again.text_sha256]
    single = found.join(again, row, "left_anti")
    columns = [F.col(f"`{name}`") for name in docs.columns]
    several = (
        found.join(again, row, "left_semi")
        .select(F.struct(*columns).alias("row"))
        .groupBy(
            F.col("row.doc_id").alias("id"),
            F.sha2(ascii_lower(F.coalesce(F.col("row.text"), F.lit(""))), 256).alias("sha256"),
        )
        .agg(F.first("row").alias("row"))
        .select("row.*")
    )
    return single.unionByName(several)
