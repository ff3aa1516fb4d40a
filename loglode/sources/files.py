"""Log files as lines: once (batch) or as they land (stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loglode.functions.text import trim_line
from loglode.model import AT, BLOCK, FILE


def read_logs(spark: SparkSession, path, modified_after: str | None = None) -> DataFrame:
    """Every line below ``path`` (file, folder, glob or list; ``.gz`` is unpacked).

    Lines end at ``\\n`` only, so a stray carriage return stays inside its line. ``_file`` is the path
    of the line's file and ``_at`` names its place there. A compressed file cannot be split and is one task; rotate by size.
    ``modified_after`` skips files last written before that time.
    """
    reader = spark.read.option("lineSep", "\n")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return with_place(with_file(reader.text(path)))


def with_file(lines: DataFrame) -> DataFrame:
    """Lines with their file, and where the part of it begins that their task reads."""
    return lines.select(
        "value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK)
    )


def with_place(lines: DataFrame) -> DataFrame:
    """Lines with ``_at``, which tells equal lines of one file apart, in place of ``_block``.

    No shuffle: it is a hash of where the task's part of the file begins and of the line's number in
    the task, so it is the same whenever the files are cut alike.
    """
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return lines.withColumn(AT, F.xxhash64(BLOCK, number)).drop(BLOCK)


def stream_logs(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Files that land in a folder, such as rotated logs; each file is read once.

    ``_file`` is the path of the line's file. Streams cannot number lines, so ``_block`` stands for their
    place; each batch makes ``_at`` of it (``with_place``).

    Lines added to a file after it was seen are not picked up: see ``tail``.
    """
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return with_file(reader.load(path))


def normalise(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines without surrounding white space."""
    return lines.withColumn(column, trim_line(lines[column]))
