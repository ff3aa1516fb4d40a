"""Word n-grams of trusted text: counts in shards of packed columns, one shuffle per order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, functions as F

from loglode.llm.shingles import give_back, mixed

#: Groups of the different words of a language by hash.
PARTS = 16
#: Words of one language and model that a task gathers before it counts them.
HELD = 2_000_000
#: One shard: the counts of n-grams whose context has one hash. ``width`` is the number of words, n{v} how many
#: n-grams the shard has of model v, repeats counted, c1 to c4 how many of the counts are one to four.
KEY = ["lang", "model", "width", "shards", "shard"]
ROWS = (
    "lang string, model int, width long, shards int, shard int, contexts binary, grams binary, "
    "n1 long, n2 long, c1 long, c2 long, c3 long, c4 long"
)
PARTIAL = "lang string, model int, width long, shards int, shard int, grams binary"


def pack(**columns: np.ndarray) -> bytes:
    """Columns in few bytes: ``key`` in ascending order by differences, counts by runs, words by byte planes."""
    kinds = {"key": "DELTA_BINARY_PACKED", "last": "BYTE_STREAM_SPLIT"}
    sink = pa.BufferOutputStream()
    pq.write_table(
        pa.table(columns), sink, compression="zstd", write_statistics=False, store_schema=False,
        use_dictionary=[name for name in columns if name not in kinds],
        column_encoding={name: kinds[name] for name in columns if name in kinds},
    )
    return sink.getvalue().to_pybytes()


def unpack(packed: bytes) -> dict[str, np.ndarray]:
    table = pq.ParquetFile(pa.BufferReader(packed)).read(use_threads=False)
    return {name: table[name].to_numpy() for name in table.column_names}


def summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The different keys in ascending order, and the sum of n of each."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    keys = [key[order] for key in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
    starts = np.flatnonzero(new)
    return [key[starts] for key in keys], np.add.reduceat(n[order], starts) if len(starts) else n[:0]


def hashed(numbers: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each context."""
    return (mixed(numbers.astype(np.uint64) + np.uint64(1)) % np.uint64(shards)).astype(np.int32)


def dealt(
    lang: str, model: int, width: int, shards: int, shard: np.ndarray, keys: list[np.ndarray], n: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """One row of partial counts for each shard; keys are in ascending order."""
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(shards + 1))
    for number in np.flatnonzero(np.diff(ends)):
        part = order[ends[number] : ends[number + 1]]
        columns = {"key": keys[0][part], **({"last": keys[1][part].astype(np.int32)} if len(keys) > 1 else {})}
        row = {
            "lang": lang, "model": model, "width": width, "shards": shards, "shard": int(number),
            "grams": pack(**columns, n=n[part].astype(np.int32)),
        }
        types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
        arrays = [pa.array([value], kind) for value, kind in zip(row.values(), types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, list(row))


def merged(table: pa.Table) -> pa.Table:
    """The partial counts of one shard to its counts."""
    out = counts_of(table)
    give_back()
    return out


def counts_of(table: pa.Table) -> pa.Table:
    parts = [unpack(blob.as_py()) for blob in table["grams"]]
    names = [name for name in ("key", "last") if name in parts[0]]
    keys = [np.concatenate([part[name] for part in parts]) for name in names]
    n = np.concatenate([part["n"] for part in parts]).astype(np.int64)
    del parts
    keys, n = summed(keys, n)
    lang, model, width, shards, shard = (table[name][0].as_py() for name in KEY)
    contexts = b""
    if len(keys) > 1:
        starts = np.flatnonzero(np.concatenate([[True], keys[0][1:] != keys[0][:-1]]))
        contexts = pack(key=keys[0][starts], size=np.diff(starts, append=len(n)).astype(np.int32))
        grams = pack(last=keys[1], n=n)
    else:
        grams = pack(key=keys[0], n=n)
    row = {
        "lang": lang, "model": model, "width": width, "shards": shards, "shard": shard,
        "contexts": contexts, "grams": grams,
        **{f"n{v}": int(n.sum()) if v == model else 0 for v in (1, 2)},
        **{f"c{k}": int(np.count_nonzero(n == k)) for k in (1, 2, 3, 4)},
    }
    types = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * 6]
    return pa.table([pa.array([value], kind) for value, kind in zip(row.values(), types, strict=True)], list(row))


def in_shards(partial: DataFrame) -> DataFrame:
    """Partial counts to one row for each shard."""
    return partial.groupBy(*KEY).applyInArrow(merged, ROWS)


def vocabulary(counts: dict[str, list[tuple[np.ndarray, np.ndarray]]], lang: str) -> Iterator[pa.RecordBatch]:
    """Words and counts of a language that a task has gathered, by the hash of the word."""
    words, n = (np.concatenate(x) for x in zip(*counts.pop(lang), strict=True))
    (words,), n = summed([words.view(np.int64)], n)
    yield from dealt(lang, 1, 0, PARTS, (words.view(np.uint64) % np.uint64(PARTS)).astype(np.int32), [words], n)


def numbers_of(files: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a language's words in order, and the number of each: frequent ones have small numbers.

    Number 0 is what stands before a text.
    """
    parts = [unpack(blob) for blob in files]
    words = np.concatenate([np.zeros(0, np.int64), *[part["key"] for part in parts]])
    n = np.concatenate([np.zeros(0, np.int64), *[part["n"] for part in parts]])
    order = np.argsort(words)
    words, n = words[order], n[order]
    number = np.empty(len(words), np.int64)
    number[np.argsort(-n, kind="stable")] = np.arange(1, len(words) + 1)
    return words, number


def numbered(words: list[np.ndarray], known: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Words before each word and itself, as hashes, to their numbers, -1 for those that are not known."""
    hashes, number = known
    found = pa.array(words[-1].view(np.int64)).dictionary_encode()
    wanted = found.dictionary.to_numpy()
    own = np.full(len(wanted), -1, np.int64)
    if len(hashes):
        order = np.argsort(wanted)
        at = np.minimum(np.searchsorted(hashes, wanted[order]), len(hashes) - 1)
        own[order] = np.where(hashes[at] == wanted[order], number[at], -1)
    last = own[found.indices.to_numpy()] if len(words[-1]) else np.zeros(0, np.int64)
    out = []
    for back in range(len(words) - 1, 0, -1):
        shifted = np.zeros(len(last), np.int64)
        shifted[back:] = last[: max(0, len(last) - back)]
        out.append(np.where(words[len(words) - 1 - back] == 0, 0, shifted))
    return [*out, last]


def trigrams(
    held: list[list[np.ndarray]], lang: str, model: int, width: int, shards: int
) -> Iterator[pa.RecordBatch]:
    """Partial counts of the n-grams that a task has gathered, by the hash of the two words before the last."""
    first, second, last = (np.concatenate(x) for x in zip(*held, strict=True))
    keys, n = summed([first * width + second, last], np.ones(len(last), np.int64))
    yield from dealt(lang, model, width, shards, hashed(keys[0], shards), keys, n)


def opened(contexts: bytes, grams: bytes, width: int) -> tuple[np.ndarray, ...]:
    """The contexts of a shard in order, how many n-grams each has, their last words and counts."""
    columns = unpack(grams)
    if contexts:
        above = unpack(contexts)
        return above["key"], above["size"], columns["last"].astype(np.int64), columns["n"]
    context, last = np.divmod(columns["key"], width)
    starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(context)), bool), context[1:] != context[:-1]]))
    return context[starts], np.diff(starts, append=len(last)), last, columns["n"]


def shorter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards of one order to partial counts of the next lower: in how many different n-grams one is the end."""
    for batch in batches:
        for row in batch.to_pylist():
            lang, model, width, shards = (row[name] for name in KEY[:4])
            context, size, last, _ = opened(row["contexts"], row["grams"], width)
            if row["contexts"]:
                last += np.repeat(context % width, size) * width
            (ends,), n = summed([last], np.ones(len(last), np.int64))
            # A single word has no context, its shard is by itself.
            parts = shards if row["contexts"] else shards // 8 + 1
            shard = hashed(ends // width if row["contexts"] else ends, parts)
            yield from dealt(lang, model, width, parts, shard, [ends], n)


def lower(shards: DataFrame) -> DataFrame:
    return in_shards(shards.select(*KEY, "contexts", "grams").mapInArrow(shorter, PARTIAL))


def shard_probabilities(
    shard: tuple[np.ndarray, ...], width: int, off: np.ndarray,
    part: np.ndarray, context: np.ndarray, last: np.ndarray, p: np.ndarray,
) -> None:
    """Put the probabilities of one shard in place of the lower order's in some places of p."""
    known, size, lasts, n = shard
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    total = np.add.reduceat(n, starts)
    ones, twos = (np.add.reduceat((n == k).astype(np.int64), starts) for k in (1, 2))
    seen = ones, twos, size - ones - twos
    share = (sum(x * d for x, d in zip(seen, off[1:], strict=True)) / total).astype(np.float32)
    at = np.minimum(np.searchsorted(known, context), len(known) - 1)
    there = known[at] == context
    part, at, last = part[there], at[there], last[there]
    grams = np.repeat(np.arange(len(known)), size) * width + lasts
    wanted = at * width + last
    where = np.minimum(np.searchsorted(grams, wanted), len(grams) - 1)
    same = (grams[where] == wanted) & (last >= 0)
    taken = (n[where] - off[np.minimum(n[where], 3)]).astype(np.float32)
    own = np.where(same, taken, 0).astype(np.float64)
    p[part] = own / total[at].astype(np.float32).astype(np.float64) + share[at] * p[part]


def looked_up(
    read: Callable[[int], Iterable[tuple[bytes, bytes]]], count: int, width: int, off: np.ndarray,
    context: np.ndarray, last: np.ndarray, p: np.ndarray,
) -> np.ndarray:
    """The probabilities of one order in place of those of the order below, which stay after an unknown context.

    Negative contexts and last words are unknown. ``read`` gives a shard by its number, if there is one.
    """
    place = hashed(np.maximum(context, 0), count)
    ends = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=count))])
    # Small numbers are sorted without comparing.
    order = np.argsort(place.astype(np.uint16) if count < 1 << 16 else place, kind="stable").astype(np.int32)
    del place
    for number in np.flatnonzero(np.diff(ends)):
        part = order[ends[number] : ends[number + 1]]
        # In order of context, which is how a shard is looked up fast.
        part = part[np.argsort(context[part])]
        for packed in read(int(number)):
            shard_probabilities(opened(*packed, width), width, off, part, context[part], last[part], p)
    return p


def single(n: np.ndarray, last: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of words by themselves, and if they are known; ``n`` has the count of each number."""
    own_n = np.where(last >= 0, n[np.maximum(last, 0)], 0)
    known = own_n > 0
    p = np.where(known, 0.0, 1.0)
    total = np.float64(np.float32(n.sum()))
    if total > 0:
        seen = [np.count_nonzero(n == 1), np.count_nonzero(n == 2), np.count_nonzero(n > 2)]
        share = np.float32(sum(x * d for x, d in zip(seen, off[1:], strict=True)) / n.sum())
        own = (own_n - off[np.minimum(own_n, 3)]).astype(np.float32).astype(np.float64)
        p = np.where(known, own, 0.0) / total + share * p
    return p, known


def count_vocabulary(
    parts: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """lang, fold and text to partial counts of words."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list] = {}
        rows: dict[str, int] = {}
        for lang, _, words in parts(batches):
            own, n = np.unique(words[-1], return_counts=True)
            counts.setdefault(lang, []).append((own, n))
            rows[lang] = rows.get(lang, 0) + len(own)
            if rows[lang] > HELD:
                rows[lang] = 0
                yield from vocabulary(counts, lang)
        for lang in list(counts):
            yield from vocabulary(counts, lang)

    return of


def count_trigrams(
    parts: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]],
    known: Callable[[str], tuple[np.ndarray, np.ndarray]],
    shards: dict[str, int],
    folds: int,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """lang, fold and text to partial counts of n-grams of three words, for each model without the fold."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], list] = {}
        rows: dict[tuple[str, int], int] = {}
        for lang, fold, words in parts(batches):
            own = numbered(words, known(lang))
            for model in (v for v in range(1, folds + 1) if v != fold + 1):
                key = lang, model
                held.setdefault(key, []).append(own)
                rows[key] = rows.get(key, 0) + len(own[0])
                if rows[key] > HELD:
                    rows[key] = 0
                    yield from trigrams(held.pop(key), *key, len(known(lang)[0]) + 1, shards[lang])
        for key in list(held):
            yield from trigrams(held.pop(key), *key, len(known(key[0])[0]) + 1, shards[key[0]])

    return of
