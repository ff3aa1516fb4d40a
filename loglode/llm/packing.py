"""Packing by power-of-two pieces: every sequence holds one piece of one document, without padding."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loglode.llm.shingles import few_rows
from loglode.llm.tokens import WORD_BPE, encoded

LENGTH = 2048
END = 1
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def piece_lengths(tokens: int, longest: int) -> list[int]:
    """As many pieces of the longest length as fit, then the powers of two that make up the rest."""
    rest = tokens % longest
    powers = [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1]
    return [longest] * (tokens // longest) + powers


def cut_tokens(path: str, longest: int, end: int) -> Callable:
    """A function from batches of doc_id and text to batches of pieces."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            rows: list[tuple] = []
            size = 0
            for doc, ids in zip(batch["doc_id"].to_pylist(), encoded(batch["text"], path)):
                ids = np.append(ids, np.uint32(end)).astype("<u4")
                start = 0
                for length in piece_lengths(len(ids), longest):
                    piece = ids[start : start + length].tobytes()
                    rows.append((doc, start, length, len(ids), piece))
                    start += length
                size += len(ids)
                if size >= 1_000_000:
                    yield made(rows)
                    rows, size = [], 0
            yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        names = ["doc_id", "start", "length", "doc_tokens"]
        columns = list(zip(*rows)) if rows else [()] * 5
        arrays = [pa.array(column, pa.int64()) for column in columns[:4]]
        return pa.record_batch([*arrays, pa.array(columns[4], pa.binary())], [*names, "ids"])

    return pieces


def packed(
    docs: DataFrame, path: str = WORD_BPE, longest: int = LENGTH, end: int = END
) -> DataFrame:
    """One row per sequence: doc_id, start, length, doc_tokens, ids, sequence_id and offset.

    A document's tokens and its end id are cut into pieces of ``longest``, itself a power of two,
    and the powers of two that make up the rest. Each piece is a sequence: no sequence crosses
    documents, none is padded, and those of one length form a bucket (``write_buckets``). ``ids``
    holds little-endian unsigned 32-bit numbers. ``sequence_id`` is unique, not gapless; ``offset``
    is the piece's place in its sequence, always 0.

    A null or empty text is one piece, the end id. Rows that repeat, doc_id too, are packed one by
    one. An empty table gives no rows. Other columns are not used. There is no shuffle.
    """
    if longest & longest - 1:
        raise ValueError("the longest piece must be a power of two")
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return texts.mapInArrow(cut_tokens(path, longest, end), PIECES).select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )


def write_buckets(sequences: DataFrame, path: str) -> None:
    """Write packed sequences, one folder per length."""
    sequences.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)
