"""Word shingles of whole Arrow text columns as sorted 64-bit hashes, with numpy."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is worked on alone.
SLICE = 1 << 19
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20
_random = np.random.Generator(np.random.PCG64(20240101))
BYTE = _random.integers(1, 2**64, 256, dtype=np.uint64)
BASE, *STEP = (int(x) | 1 for x in _random.integers(1, 2**64, 17, dtype=np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def give_back() -> None:
    """Return freed memory to the system: a worker is kept after its task, beside the tasks that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def released(work: Callable) -> Callable:
    """The same work of a task on batches, after which its worker, which Spark keeps, holds no freed memory."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return of


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in shorter ones, so that what is made of one takes little memory."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def slices(offsets: np.ndarray, most: int = SLICE) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def words_of(offsets: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of each word, where it starts and its length; ``chars`` starts with the first text."""
    bounds = offsets - int(offsets[0])
    solid = ~SPACE[chars]
    edge = np.zeros(len(chars) + 1, bool)
    edge[bounds] = True
    after_gap = np.ones(len(chars), bool)
    after_gap[1:] = ~solid[:-1]
    starts = np.flatnonzero(solid & (after_gap | edge[:-1]))
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    before_gap = np.ones(len(chars), bool)
    before_gap[:-1] = ~solid[1:]
    lengths = np.flatnonzero(solid & (before_gap | edge[1:])) + 1 - starts
    ends = np.cumsum(lengths)
    inside = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
    powers = np.full(int(lengths.max()), BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    weighed = BYTE[chars[np.repeat(starts, lengths) + inside]] * powers[inside]
    hashes = np.add.reduceat(weighed, ends - lengths) + lengths.astype(np.uint64)
    return mixed(hashes), starts, lengths


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, and at which word each text starts (with the end)."""
    chars = FOLD[data[int(offsets[0]) : int(offsets[-1])]]
    hashes, starts, _ = words_of(offsets, chars)
    return hashes, np.searchsorted(starts, offsets - int(offsets[0]))


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Per text its sorted distinct shingles; a shorter text's words are one shingle."""
    offsets, data = buffers(texts)
    for first, last in slices(offsets):
        hashes, places = word_hashes(offsets[first : last + 1], data)
        run = max(0, len(hashes) - words + 1)
        joined = np.zeros(run, np.uint64)
        for i in range(words):
            joined += hashes[i : i + run] * np.uint64(STEP[i])
        joined = mixed(joined)
        for start, end in zip(places[:-1], places[1:], strict=True):
            if end - start >= words:
                yield np.unique(joined[start : end - words + 1])
            elif end > start:
                short = hashes[start:end] * np.array(STEP[: end - start], np.uint64)
                yield mixed(short.sum(dtype=np.uint64, keepdims=True) + np.uint64(end - start))
            else:
                yield np.zeros(0, np.uint64)
