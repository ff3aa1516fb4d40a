"""A streaming source for log files that are still being written.

    spark.dataSource.register(TailSource)
    spark.readStream.format("log_tail").load("/shared/logs/access.log")

Every batch reads the bytes added since the last one, up to the last complete line, in ranges that
executors read side by side. A file is known by its inode and first line, so what was written to it
before a rotation is read under whatever name it has in its folder afterwards. A copy that was made
before the log was emptied goes on where the log was left. A file cut back to nothing starts over.
A log that is gone before its last lines could be read, deleted or packed, ends the stream with an
error.

The driver and all executors must see the files under the same local path; other file systems are
refused. Options: ``startingOffsets`` is ``earliest`` (default) or ``latest``; ``rangeBytes`` is the
size of one task's share. ``_at`` is the byte of its file where a line begins.
"""

from __future__ import annotations

import glob
import os
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

COMPRESSED = (".gz", ".bz2", ".xz", ".zst", ".lz4")
CHUNK = 4 * 1024 * 1024
#: Bytes before the place reached whose checksum tells a copy of the log from another file.
TRACE = 4096


@dataclass
class ByteRange(InputPartition):
    path: str
    key: str
    first: int  # where the unread part of the file begins
    begin: int
    end: int


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "value string, _file string, _at bigint"

    def streamReader(self, schema) -> "TailReader":
        return TailReader(self.options)


class TailReader(DataSourceStreamReader):
    """Offsets map a file's key to [bytes done, checksum of the bytes before, 1 for a live log]."""

    def __init__(self, options: dict):
        self.path = options["path"].removeprefix("file://").removeprefix("file:")
        if "://" in self.path or not os.path.isabs(self.path):
            raise ValueError(f"log_tail follows files below an absolute local path, not {self.path!r}")
        self.start = options.get("startingOffsets", "earliest")
        if self.start not in ("earliest", "latest"):
            raise ValueError(f"startingOffsets must be earliest or latest, not {self.start!r}")
        self.range_bytes = int(options.get("rangeBytes", 64 * 1024 * 1024))
        self.known: dict[str, list[int]] = {}

    def initialOffset(self) -> dict:
        live = set(glob.glob(self.path))
        # Files rotated away before the start are not read.
        self.known = {
            key: place(path, complete_bytes(path) if self.start == "latest" or path not in live else 0, path in live)
            for key, path in watched(self.path, {}).items()
        }
        return self.known

    def latestOffset(self) -> dict:
        live = set(glob.glob(self.path))
        found = {
            key: place(path, complete_bytes(path), path in live)
            for key, path in watched(self.path, self.known).items()
        }
        # A new file that begins like a live log is a copy of it, read once the log is emptied.
        whole = {key.partition("-")[2] for key, (_, _, is_live) in found.items() if is_live}
        self.known = {
            key: state
            for key, state in found.items()
            if state[2] or key in self.known or key.partition("-")[2] not in whole
        }
        return self.known

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        self.known = end
        files = watched(self.path, end)
        lost = [key for key, (_, _, live) in start.items() if live and key not in end]
        ranges = []
        for key, (stop, _, _) in sorted(end.items()):
            first = start[key][0] if key in start else 0
            if key not in start:
                for old in list(lost):
                    if same_text(files.get(key, ""), key, old, start[old]):
                        # A copy of the log, made before the log was emptied.
                        first = start[old][0]
                        lost.remove(old)
            for begin in range(first, stop, self.range_bytes):
                upto = min(begin + self.range_bytes, stop)
                ranges.append(ByteRange(files.get(key, ""), key, first, begin, upto))
        unread = [key for key in lost if not emptied(key, end, files)]
        if unread:
            raise FileNotFoundError(
                f"a log of {self.path!r} went away, deleted or packed, before its end was read"
            )
        return ranges

    def read(self, part: ByteRange):
        path = part.path
        if not path or file_key(path) != part.key:
            # Renamed between planning and reading.
            path = watched(self.path, {part.key: []}).get(part.key)
            if path is None:
                raise FileNotFoundError(f"log file {part.path!r} went away before it was read")
        with open(path, "rb") as file:
            yield from _batches(file, part, path)

    def commit(self, end: dict) -> None:
        pass


def _batches(file, part: ByteRange, path: str):
    """Lines that begin inside the range, in record batches."""
    at = part.begin
    if part.begin > part.first:
        # The line running into the range belongs to the range before it.
        file.seek(part.begin - 1)
        at = part.begin - 1 + len(file.readline())
    file.seek(at)
    while at < part.end:
        block = file.read(min(CHUNK, part.end - at))
        if not block:
            raise EOFError(f"log file {part.path!r} was cut short while it was read")
        if not block.endswith(b"\n"):
            block += file.readline()
        lines = block.decode("utf-8", "replace").split("\n")[:-1]
        ends = np.flatnonzero(np.frombuffer(block, np.uint8) == ord("\n")) + 1
        places = at + np.concatenate([[0], ends[:-1]]).astype(np.int64)
        at += len(block)
        names = pa.array([os.path.basename(path)] * len(lines), pa.string())
        texts = pa.array(lines, pa.string())
        yield pa.RecordBatch.from_pydict({"value": texts, "_file": names, "_at": pa.array(places)})


def watched(path: str, known: dict) -> dict[str, str]:
    """Key and path of the files to follow.

    These are the live logs, what stands beside them under their name and a suffix, and any other
    file of their folders that is known already.
    """
    found = {}
    live = set(glob.glob(path))
    named = live | {name for mark in ".-_" for name in glob.glob(f"{path}{mark}*")}
    folders = {os.path.dirname(name) for name in named} | {os.path.dirname(path)}
    beside = {
        entry.path
        for folder in folders
        if known and os.path.isdir(folder)
        for entry in os.scandir(folder)
        if entry.is_file()
    }
    # Live logs last: where a copy has a log's inode again, the log itself counts.
    for name in [*sorted((beside | named) - live), *sorted(live)]:
        if not name.endswith(COMPRESSED):
            key = file_key(name)
            if key and (name in named or key in known):
                found[key] = name
    return found


def file_key(path: str) -> str | None:
    """Names a file across renames; None until its first line is complete."""
    try:
        with open(path, "rb") as file:
            first = file.readline()
            inode = os.fstat(file.fileno()).st_ino
    except OSError:
        return None
    return f"{inode}-{zlib.crc32(first):08x}" if first.endswith(b"\n") else None


def place(path: str, done: int, live: bool) -> list[int]:
    return [done, trace(path, done), int(live)]


def trace(path: str, done: int) -> int:
    """Checksum of the last bytes before a place in a file."""
    with open(path, "rb") as file:
        file.seek(max(0, done - TRACE))
        return zlib.crc32(file.read(done - max(0, done - TRACE)))


def same_text(path: str, key: str, old: str, state: list[int]) -> bool:
    """Whether a file begins as another one did, up to the place reached there."""
    if not path or key.partition("-")[2] != old.partition("-")[2]:
        return False
    return os.path.getsize(path) >= state[0] and trace(path, state[0]) == state[1]


def emptied(key: str, end: dict, files: dict[str, str]) -> bool:
    """Whether the file of a key is there still, begun anew or not begun yet."""
    inode = key.partition("-")[0]
    if any(other.partition("-")[0] == inode for other in end):
        return True
    folder = {os.path.dirname(path) for path in files.values()}
    return any(str(entry.inode()) == inode for place in folder for entry in os.scandir(place))


def complete_bytes(path: str) -> int:
    """Bytes up to and including the last line end."""
    with open(path, "rb") as file:
        at = file.seek(0, os.SEEK_END)
        while at > 0:
            begin = max(0, at - 64 * 1024)
            file.seek(begin)
            last = file.read(at - begin).rfind(b"\n")
            if last >= 0:
                return begin + last + 1
            at = begin
    return 0
