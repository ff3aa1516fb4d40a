"""Token ids in Arrow stream files: equal-length sequences and masks that can be mapped into memory."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from loglode.llm.shingles import few_rows
from loglode.llm.tables import stored
from loglode.llm.tokens import BYTE_BPE, encoded
from loglode.session import fresh_dir

LENGTH = 2048
END = 0
#: Sequences in a batch of a file; every batch but a file's last has as many.
BATCH = 256
MANIFEST = "file string, part long, documents long, tokens long, sequences long"
FOUND = "doc_id long, start long, n_tokens long, ids_crc32 long"


def file_schema(length: int, wide: bool) -> pa.Schema:
    """ids, mask (true: a token, not padding) and ends (true: the last token of a document)."""
    flags = pa.list_(pa.bool_(), length)
    ids = pa.list_(pa.uint32() if wide else pa.uint16(), length)
    return pa.schema([("ids", ids), ("mask", flags), ("ends", flags)])


class SequenceWriter:
    """Cuts a run of documents into sequences and writes them in batches."""

    def __init__(self, sink, length: int, wide: bool):
        self.schema = file_schema(length, wide)
        self.length = length
        self.writer = pa.ipc.new_stream(sink, self.schema)
        self.dtype = np.uint32 if wide else np.uint16
        self.ids: list[np.ndarray] = []
        self.ends: list[np.ndarray] = []
        self.waiting = self.tokens = self.sequences = 0

    def add(self, ids: np.ndarray) -> None:
        ends = np.zeros(len(ids), bool)
        ends[-1] = True
        self.ids.append(ids.astype(self.dtype))
        self.ends.append(ends)
        self.waiting += len(ids)
        self.tokens += len(ids)
        if self.waiting >= self.length * BATCH:
            self.flush(last=False)

    def flush(self, last: bool) -> None:
        ids = np.concatenate([np.zeros(0, self.dtype), *self.ids])
        ends = np.concatenate([np.zeros(0, bool), *self.ends])
        group = self.length * BATCH
        while len(ids) >= group or last and len(ids):
            some, marks = ids[:group], ends[:group]
            ids, ends = ids[group:], ends[group:]
            rows = -(-len(some) // self.length)
            pad = rows * self.length - len(some)
            columns = [np.pad(some, (0, pad)), np.arange(rows * self.length) < len(some), np.pad(marks, (0, pad))]
            lists = [
                pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in columns
            ]
            self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
            self.sequences += rows
        self.ids, self.ends, self.waiting = [ids], [ends], len(ids)

    def close(self) -> None:
        self.flush(last=True)
        self.writer.close()


def write_part(folder: str, path: str, end: int, length: int, wide: bool) -> Callable:
    """Sorted rows of doc_id and text to one file of sequences and one of doc_ids per task."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task that runs again writes files of its own; the manifest names those of the one
        # that ended well.
        part = TaskContext.get().partitionId()
        store, place = fs.FileSystem.from_uri(folder)
        name = f"part-{part:06d}-{uuid.uuid4().hex[:12]}"
        out = count = None
        for batch in few_rows(batches, 2000):
            if out is None:
                data = store.open_output_stream(f"{place}/{name}.arrows")
                numbers = store.open_output_stream(f"{place}/{name}.docs.arrows")
                out, count = SequenceWriter(data, length, wide), 0
                docs = pa.ipc.new_stream(numbers, pa.schema([("doc_id", pa.int64())]))
            for ids in encoded(batch["text"], path):
                out.add(np.append(ids, np.uint32(end)))
            docs.write_batch(pa.RecordBatch.from_arrays([batch["doc_id"]], ["doc_id"]))
            count += batch.num_rows
        if out is not None:
            out.close()
            docs.close()
            data.close()
            numbers.close()
            row = [[f"{folder}/{name}"], [part], [count], [out.tokens], [out.sequences]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(row[0]), *[pa.array(x, pa.int64()) for x in row[1:]]],
                ["file", "part", "documents", "tokens", "sequences"],
            )

    return write


def write_sequences(
    docs: DataFrame,
    folder: str | None = None,
    path: str = BYTE_BPE,
    end: int = END,
    length: int = LENGTH,
) -> DataFrame:
    """Write all documents in ascending order of doc_id; gives one row per file, the manifest.

    Each task writes one range of doc_ids as an Arrow stream of fixed-size lists: ids (unsigned 16
    bits, 32 for larger vocabularies), a mask that is false for the padding of the file's last
    sequence, and the ends of documents. Batches have equal numbers of sequences, so a reader maps
    the file and takes the k-th sequence without copying. The doc_ids stand in a stream beside it.
    ``folder`` is a URI or path that all executors reach; by default below the shared folder.

    A null text is empty and has the end id only. Rows with one doc_id are ordered by text, null
    first; a null doc_id comes first. An empty table gives no file. Other columns are not used.
    """
    from tokenizers import Tokenizer

    wide = max(Tokenizer.from_file(path).get_vocab_size(), end + 1) > 1 << 16
    folder = folder or fresh_dir(docs.sparkSession, "sequences")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    store, place = fs.FileSystem.from_uri(folder)
    store.create_dir(place, recursive=True)
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    order = ["doc_id", "text"]
    # The beginning of the text spreads the rows that share a doc_id, in the same order.
    ranged = texts.repartitionByRange("doc_id", F.substring("text", 1, 16)).sortWithinPartitions(*order)
    return stored(ranged.mapInArrow(write_part(folder, path, end, length, wide), MANIFEST), "manifest")


def open_file(name: str, suffix: str) -> pa.RecordBatchStreamReader:
    """A stream file; on a local file system it is mapped into memory, not read."""
    store, place = fs.FileSystem.from_uri(f"{name}{suffix}")
    local = isinstance(store, fs.LocalFileSystem)
    return pa.ipc.open_stream(pa.memory_map(place) if local else store.open_input_stream(place))


def documents_of(name: str, first: int) -> Iterator[pa.RecordBatch]:
    """Per document of a file: doc_id, start, tokens and checksum, batch by batch."""
    numbers = (x for batch in open_file(name, ".docs.arrows") for x in batch["doc_id"].to_pylist())
    start, size, crc = first, 0, 0
    for batch in open_file(name, ".arrows"):
        flat = {key: batch[key].flatten().to_numpy(zero_copy_only=False) for key in ("ids", "mask", "ends")}
        ids = flat["ids"][flat["mask"]].astype("<u4")
        ends = np.flatnonzero(flat["ends"][flat["mask"]]) + 1
        rows, begin = [], 0
        for stop in ends.tolist():
            crc = zlib.crc32(ids[begin:stop], crc)
            size += stop - begin
            rows.append((next(numbers), start, size, crc))
            start, size, crc, begin = start + size, 0, 0, stop
        crc = zlib.crc32(ids[begin:], crc)
        size += len(ids) - begin
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, first in zip(batch["file"].to_pylist(), batch["first"].to_pylist(), strict=True):
            yield from documents_of(name, first)


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document, read from the files of a manifest: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it. Only the manifest, one row per file, is
    added up in one task.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("tokens").over(before), F.lit(0))
    files = stored(manifest.select("file", "part", first.alias("first")), "files")
    count = max(1, files.count())
    return files.repartitionByRange(count, "part").mapInArrow(read_part, FOUND)


def sequences(name: str) -> pa.Table:
    """The sequences of one file of a manifest: ids, mask and ends, mapped where the file is local."""
    return open_file(name, ".arrows").read_all()
