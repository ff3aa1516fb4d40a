"""Quality by interpolated modified Kneser-Ney models of trusted text: words, and bytes that spell them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from loglode.llm import word_grams
from loglode.llm.shingles import buffers, give_back, released, slices, words_of
from loglode.llm.tables import short_batches, sized, stored
from loglode.session import fresh_dir

#: Bytes of an n-gram at most. They fit in one number, so no two n-grams are confused.
ORDER = 5
#: Most n-grams in a shard. A task holds one shard at a time, some 20 MB.
SHARD = 1_000_000
#: Words of an n-gram at most, and where sizes of word n-grams begin, model by model: those of bytes and
#: of words lie in one folder. The words themselves, hashes of 64 bits, have the first of these sizes.
WORDS, ABOVE = 3, 100
#: Added to the size of a context, and to an order, for the places of contexts and discounts.
CONTEXT, DISCOUNT = 50, 80
#: Model 0 is of all trusted text, each other one of what is not in a fold; a text's fold is its hash.
FOLDS = 2
#: The share of trusted documents that lie within the limit of bytes and words together.
QUANTILE = 0.99
#: Bytes of average text that each document is taken to hold besides its own, so that a few words
#: alone do not condemn it.
PRIOR = 200
#: Steps of the logarithm of perplexity in which quantiles are counted.
STEP = 0.001
#: Bytes of text that are put in order of language and fold, so that one model at a time is held.
GROUP = 32 << 20
#: Bytes of one language and fold whose byte n-grams are looked up at once; words are by GROUP.
PART = 1 << 20
#: Bits of a hash that decide whether a document is in the sample.
BITS = 52
GRAM_ROWS = "lang string, fold int, gram long, n long"
SHARD_KEY = ["tongue", "size", "shards", "shard"]


def keys(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Per byte the n-gram that it ends, packed into a number; zeros stand before a text."""
    begin = int(offsets[0])
    chars = data[begin : int(offsets[-1])].astype(np.uint64)
    packed = chars.copy()
    for back in range(1, min(ORDER, len(chars))):
        packed[back:] |= chars[:-back] << np.uint64(8 * back)
    for place in range(ORDER - 1):
        # The bytes of the text before are none of this one's.
        at = offsets[:-1][np.diff(offsets) > place] - begin + place
        packed[at] &= np.uint64((1 << 8 * (place + 1)) - 1)
    return packed


def distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers, and for each place which of them stands there."""
    found = pa.array(numbers.view(np.int64)).dictionary_encode()
    return found.dictionary.to_numpy().view(np.uint64), found.indices.to_numpy()


def word_keys(offsets: np.ndarray, data: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The words before each word and itself, their starts and ends; zeros stand before a text."""
    begin = int(offsets[0])
    words, starts, lengths = words_of(offsets, data[begin : int(offsets[-1])])
    first = np.searchsorted(starts, offsets - begin)
    from_start = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    out = []
    for back in range(WORDS - 1, -1, -1):
        shifted = np.zeros(len(words), np.uint64)
        shifted[back:] = words[: max(0, len(words) - back)]
        out.append(np.where(from_start >= back, shifted, 0).astype(np.uint64))
    return out, starts, starts + lengths


def of_each(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The values of some columns that occur together, and the rows that have them."""
    rows: dict[tuple, list[int]] = {}
    for at, values in enumerate(zip(*(batch[name].to_pylist() for name in names), strict=True)):
        rows.setdefault(values, []).append(at)
    for values in sorted(rows):
        yield *values, np.array(rows[values])


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, fold and text to the counts of byte n-grams of the highest order."""
    for batch in gathered(batches):
        for lang, fold, rows in of_each(batch, "lang", "fold"):
            offsets, data = buffers(batch["text"].take(pa.array(rows)))
            for first, last in slices(offsets, 2 << 20):
                grams, counts = np.unique(keys(offsets[first : last + 1], data), return_counts=True)
                yield counted(lang, fold, {"gram": grams}, counts)


def words_by(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """lang, fold and text to the words before each word and itself, of some texts of one language and fold."""
    for batch in gathered(batches):
        for lang, fold, rows in of_each(batch, "lang", "fold"):
            offsets, data = buffers(batch["text"].take(pa.array(rows)))
            for first, last in slices(offsets, 2 << 20):
                words, _, _ = word_keys(offsets[first : last + 1], data)
                if len(words[-1]):
                    yield lang, fold, words


def counted(lang: str, fold: int, grams: dict[str, np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
    columns = {
        "lang": pa.array([lang] * len(counts), pa.string()),
        "fold": pa.array(np.full(len(counts), fold, np.int32)),
        **{name: pa.array(x.view(np.int64)) for name, x in grams.items()},
        "n": pa.array(counts, pa.int64()),
    }
    return pa.RecordBatch.from_pydict(columns)


@dataclass(frozen=True)
class Bytes:
    """How n-grams of bytes, packed into the number ``gram``, are taken apart."""

    order: int
    models: tuple[int, ...] = tuple(range(FOLDS + 1))

    def key(self, size: int) -> list[str]:
        return ["gram"]

    def context(self, size: int) -> dict[str, Column]:
        return {"c1": F.shiftright("gram", 8)}

    def end(self, size: int) -> dict[str, Column]:
        return {"e1": F.col("gram").bitwiseAND(F.lit((1 << 8 * (size - 1)) - 1))}

    def number(self, names: list[str]) -> Column:
        return F.col(names[0])


@dataclass(frozen=True)
class Words:
    """N-grams of words. They are looked up in the models without a fold alone."""

    order: int


def by_model(counts: DataFrame, kind: Bytes) -> DataFrame:
    """Counts by fold to the counts of each model v, nv."""
    sums = [
        F.sum(F.when(F.lit(v == 0) | (F.col("fold") + 1 != v), F.col("n")).otherwise(0)).alias(f"n{v}")
        for v in kind.models
    ]
    return counts.groupBy("lang", *kind.key(kind.order)).agg(*sums)


def off(v: int | str, k: int) -> Column:
    """What is taken off a count of k of model v, from how many counts nv1 to nv4 are one to four."""
    n = {i: F.col(f"n{v}{i}") for i in (1, 2, 3, 4)}
    share = n[1] / F.greatest(n[1] + 2 * n[2], F.lit(1.0))
    value = k - (k + 1) * share * n[k + 1] / n[k]
    return F.when(n[k] > 0, F.greatest(F.lit(0.05), F.least(value, F.lit(k - 0.05)))).otherwise(0.5)


def discounts(counts: DataFrame, models: tuple[int, ...]) -> DataFrame:
    """lang, rows and for each model v dv1, dv2 and dv3: what is taken off counts of one, two and more."""
    seen = counts.groupBy("lang").agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.sum(F.when(F.col(f"n{v}") == k, 1).otherwise(0)).cast("double").alias(f"n{v}{k}")
            for v in models
            for k in (1, 2, 3, 4)
        ],
    )

    return seen.select("lang", "rows", *[off(v, k).alias(f"d{v}{k}") for v in models for k in (1, 2, 3)])


def write_model(grams: DataFrame, kind: Bytes | Words, folder: str) -> None:
    """Write the models of n-grams as counts, sorted, files per language, size and shard, below the folder.

    ``grams`` has the counts of the highest order. A lower order counts in how many different
    n-grams of the next one it is the end. For each context there are the sum of the counts after it
    and how many of them are one, two and more. Nothing is joined: probabilities are worked out where
    they are looked up, from a count, its context and the discounts. Of words, ``grams`` are the shards
    of the highest order, already in the folder, and a shard has counts and contexts together.
    """
    if isinstance(kind, Words):
        for size in range(kind.order, 0, -1):
            write_word_discounts(grams, size, folder)
            if size > 1:
                grams = written_words(word_grams.lower(grams), size - 1, folder)
        return
    counts = grams
    for size in range(kind.order, 0, -1):
        facts = stored(discounts(counts, kind.models), "discounts")
        number = kind.number(kind.key(size)).alias("gram")
        write_shards(counts.select("lang", number, *[f"n{v}" for v in kind.models]), facts, size, folder)
        context = kind.context(size)
        after = [
            value.alias(name)
            for v in kind.models
            for n in [F.col(f"n{v}")]
            for name, value in (
                (f"total{v}", F.sum(n)),
                (f"ones{v}", F.count(F.when(n == 1, 1))),
                (f"twos{v}", F.count(F.when(n == 2, 1))),
                (f"more{v}", F.count(F.when(n > 2, 1))),
            )
        ]
        rows = counts.select("lang", *[x.alias(name) for name, x in context.items()], *[f"n{v}" for v in kind.models])
        contexts = rows.groupBy("lang", *context).agg(*after)
        number = kind.number(list(context)) if context else F.lit(0).cast("long")
        found = contexts.drop(*context).columns[1:]
        write_shards(
            contexts.select("lang", number.alias("gram"), *found), facts, CONTEXT + size - 1, folder
        )
        one = facts.withColumn("gram", F.lit(0).cast("long")).drop("rows")
        write_shards(one, None, DISCOUNT + size, folder)
        if size > 1:
            end = [x.alias(name) for x, name in zip(kind.end(size).values(), kind.key(size - 1), strict=True)]
            longer = counts.select("lang", *end, *[f"n{v}" for v in kind.models])
            ends = [F.count(F.when(F.col(f"n{v}") > 0, 1)).alias(f"n{v}") for v in kind.models]
            counts = stored(longer.groupBy("lang", *kind.key(size - 1)).agg(*ends), "grams")


def written_words(shards: DataFrame, order: int, folder: str) -> DataFrame:
    """The shards of word n-grams of one order, written once below the folder and read from there."""
    placed = shards.withColumns({"tongue": tongue_of("lang"), "size": F.col("model") * ABOVE + order})
    path = f"{folder}/words{order}"
    placed.write.partitionBy(*SHARD_KEY).parquet(path)
    spark = shards.sparkSession
    return spark.read.schema(placed.schema).parquet(path).select(*shards.columns)


def write_word_discounts(shards: DataFrame, order: int, folder: str) -> None:
    seen = shards.groupBy("lang", "model").agg(*[F.sum(f"c{k}").cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)])
    placed = seen.select(
        tongue_of("lang").alias("tongue"),
        (F.col("model") * ABOVE + order + DISCOUNT).alias("size"),
        F.lit(1).alias("shards"),
        F.lit(0).alias("shard"),
        *[off("", k).alias(f"d{k}") for k in (1, 2, 3)],
    )
    placed.write.mode("append").partitionBy(*SHARD_KEY).parquet(folder)


def word_shards(trusted: DataFrame, kind: Words, folder: str) -> DataFrame:
    """The shards of word n-grams of the highest order of lang, fold and text, written below the folder.

    The different words of each language are counted first, so that an n-gram is a few small numbers.
    """
    counts = word_grams.in_shards(
        trusted.mapInArrow(released(word_grams.count_vocabulary(words_by)), word_grams.PARTIAL)
    )
    known = f"{folder}/words"
    sizes = written_words(counts, 0, known).groupBy("lang").agg(F.sum("n1").alias("n")).collect()
    # A text is in all models but one.
    shards = {row.lang: row.n * (FOLDS - 1) // FOLDS // SHARD + 1 for row in sizes}
    count = word_grams.count_trigrams(words_by, words_in(known), shards, FOLDS)
    partial = trusted.mapInArrow(without_models(count), word_grams.PARTIAL)
    return written_words(word_grams.in_shards(partial), kind.order, folder)


def tongue_of(lang: str) -> Column:
    return F.concat(F.lit("l"), F.hex(lang))


def write_shards(rows: DataFrame, facts: DataFrame | None, size: int, folder: str) -> None:
    """Write the rows of one size; ``facts`` tells how many there are at most, one of a language if None."""
    # An odd number of shards, so that the last byte alone does not choose.
    shards = F.lit(1)
    values = [name for name in rows.columns if name not in ("lang", "gram")]
    if facts is not None:
        rows = rows.join(F.broadcast(facts.select("lang", "rows")), "lang")
        shards = (F.floor(F.col("rows") / SHARD / 2) * 2 + 1).cast("int")
    placed = rows.select(
        tongue_of("lang").alias("tongue"),
        F.lit(size).alias("size"),
        shards.alias("shards"),
        F.pmod(F.shiftrightunsigned("gram", 1), shards).cast("int").alias("shard"),
        "gram",
        *values,
    )
    ranged = placed.repartition(*SHARD_KEY).sortWithinPartitions(*SHARD_KEY, "gram")
    ranged.write.mode("append").partitionBy(*SHARD_KEY).parquet(folder)


class Model:
    """The shards of a folder as a task looks them up: a few at a time, the last used ones kept."""

    #: Most n-grams held, of 16 bytes each.
    HELD = 4_000_000

    def __init__(self, folder: str):
        self.store, place = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        self.files: dict[tuple[str, int], dict[int, list[str]]] = {}
        self.shards: dict[tuple[str, int], int] = {}
        for info in self.store.get_file_info(fs.FileSelector(place, recursive=True)):
            parts = dict(part.split("=", 1) for part in info.path.split("/") if "=" in part)
            if info.path.endswith(".parquet"):
                key = parts["tongue"], int(parts["size"])
                self.shards[key] = int(parts["shards"])
                self.files.setdefault(key, {}).setdefault(int(parts["shard"]), []).append(info.path)
        self.held: dict[tuple, tuple[np.ndarray, ...]] = {}
        self.numbers: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def read(self, tongue: str, size: int, number: int, columns: list[str]) -> list[np.ndarray]:
        tables = [
            pq.ParquetFile(self.store.open_input_file(path)).read(columns, use_threads=False)
            for path in self.files.get((tongue, size), {}).get(number, [])
        ]
        table = pa.concat_tables(tables) if tables else pa.table({name: [] for name in columns})
        return [table[name].to_numpy() for name in columns]

    def words(self, tongue: str) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of the words of a language in order, and their numbers."""
        if tongue not in self.numbers:
            shards = sorted(self.files.get((tongue, ABOVE), {}))
            found = word_grams.numbers_of(
                [blob for number in shards for blob in self.packed(tongue, ABOVE, number, ["grams"])[0]]
            )
            while self.numbers and sum(len(x[0]) for x in self.numbers.values()) + len(found[0]) > self.HELD:
                self.numbers.pop(next(iter(self.numbers)))
            self.numbers[tongue] = found
        return self.numbers[tongue]

    def only(self, tongue: str) -> None:
        """Forget what is held of other languages."""
        self.numbers = {key: held for key, held in self.numbers.items() if key == tongue}
        self.held = {key: held for key, held in self.held.items() if key[0] == tongue}

    def packed(self, tongue: str, size: int, number: int, columns: list[str]) -> list[list[bytes]]:
        return [list(column) for column in self.read(tongue, size, number, columns)]

    def taken_off(self, tongue: str, size: int, columns: list[str]) -> np.ndarray:
        """What is taken off a count of none, one, two and more."""
        found = self.read(tongue, size + DISCOUNT, 0, columns)
        return np.array([0.0, *(x[0] if len(x) else 0.5 for x in found)])

    def shard(self, tongue: str, size: int, number: int, model: int) -> tuple[np.ndarray, ...]:
        """N-grams in order with their discounted counts, or contexts with their sums and shares.

        The share of a context is what its discounts leave to the lower order.
        """
        key = tongue, size, number, model
        if key in self.held:
            self.held[key] = self.held.pop(key)
            return self.held[key]
        of_context = size >= CONTEXT
        order = size - CONTEXT + 1 if of_context else size
        off = self.taken_off(tongue, order, [f"d{model}{k}" for k in (1, 2, 3)])
        if of_context:
            names = [f"{name}{model}" for name in ("total", "ones", "twos", "more")]
            grams, total, *seen = self.read(tongue, size, number, ["gram", *names])
            share = sum(x * d for x, d in zip(seen, off[1:], strict=True)) / np.maximum(total, 1)
            values = [total, share]
        else:
            grams, total = self.read(tongue, size, number, ["gram", f"n{model}"])
            values = [total - off[np.minimum(total, 3).astype(np.int64)]]
        # What only other models have counts nothing here.
        some = np.flatnonzero(total > 0)
        grams = grams[some].astype(np.int64)
        values = [value[some].astype(np.float32) for value in values]
        if np.any(grams[1:] < grams[:-1]):
            # Several files, each in order.
            order = np.argsort(grams)
            grams, values = grams[order], [value[order] for value in values]
        held = grams, *values
        while self.held and sum(len(x[0]) for x in self.held.values()) + len(grams) > self.HELD:
            self.held.pop(next(iter(self.held)))
        self.held[key] = held
        return held

    def has(self, tongue: str, model: int) -> bool:
        return self.look_up(tongue, CONTEXT, np.zeros(1, np.uint64), model)[0][0] > 0

    def look_up(self, tongue: str, size: int, grams: np.ndarray, model: int) -> list[np.ndarray]:
        """The values of each n-gram or context, 0 where the model has none."""
        out = [np.zeros(len(grams)) for _ in range(2 if size >= CONTEXT else 1)]
        count = self.shards.get((tongue, size), 0)
        places = (grams >> np.uint64(1)) % np.uint64(count) if count > 1 else None
        ordered = np.argsort(grams.view(np.int64))
        for number in range(count):
            part = ordered if count == 1 else ordered[places[ordered] == number]
            wanted = grams[part].view(np.int64)
            if not len(wanted):
                continue
            known, *values = self.shard(tongue, size, number, model)
            if len(known):
                at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
                for one, value in zip(out, values, strict=True):
                    one[part] = np.where(known[at] == wanted, value[at], 0)
        return out

    def above(
        self, tongue: str, size: int, gram: np.ndarray, context: np.ndarray, lower: np.ndarray, model: int
    ) -> np.ndarray:
        """The probabilities of one order in place of those of the order below, which stay after an unknown context."""
        total, share = self.look_up(tongue, size + CONTEXT - 1, context, model)
        some = np.flatnonzero(total > 0)
        (own,) = self.look_up(tongue, size, gram[some], model)
        lower[some] = own / total[some] + share[some] * lower[some]
        return lower

    def surprise(self, tongue: str, grams: np.ndarray, models: list[int]) -> Iterator[np.ndarray]:
        """For each model, per n-gram the negative logarithm of its last byte's probability after the others."""
        ends = [(grams, np.zeros(0, np.int64))]
        for size in range(ORDER - 1, 0, -1):
            ends.append(distinct(ends[-1][0] & np.uint64((1 << 8 * size) - 1)))
        for model in models:
            p = np.full(len(ends[-1][0]), 1 / 256)
            for size in range(1, ORDER + 1):
                own = ends[ORDER - size][0]
                p = self.above(tongue, size, own, own >> np.uint64(8), p, model)
                if size < ORDER:
                    p = p[ends[ORDER - size][1]]
            yield -np.log(p)

    def spelling(self, tongue: str, offsets: np.ndarray, data: np.ndarray, models: list[int]) -> list[np.ndarray]:
        """For each model the surprise of all bytes before each byte, and of all of them."""
        grams, back_to = distinct(keys(offsets, data))
        out = []
        for surprise in self.surprise(tongue, grams, models):
            sums = np.zeros(len(back_to) + 1)
            np.cumsum(surprise[back_to], out=sums[1:])
            out.append(sums)
        return out

    def word_surprise(self, tongue: str, words: list[np.ndarray], model: int) -> tuple[np.ndarray, np.ndarray]:
        """Per word the negative logarithm of its probability after the others, and if it is known.

        ``words`` are numbers of the language's vocabulary. That of an unknown word is without its spelling.
        """
        width = len(self.words(tongue)[0]) + 1
        *before, last = words
        size = ABOVE * model + 1
        counts = np.zeros(width, np.int64)
        for number in self.files.get((tongue, size), {}):
            for blob in self.packed(tongue, size, number, ["grams"])[0]:
                found = word_grams.unpack(blob)
                counts[found["key"]] = found["n"]
        off = ["d1", "d2", "d3"]
        p, known = word_grams.single(counts, last, self.taken_off(tongue, size, off))
        for order in range(2, WORDS + 1):
            size = ABOVE * model + order
            context, *more = before[WORDS - order :]
            context = context.astype(np.int64)
            for word in more:
                context = np.where((context >= 0) & (word >= 0), context * width + word, -1)
            shards = self.shards.get((tongue, size), 0)
            if shards:
                taken = self.taken_off(tongue, size, off)
                p = word_grams.looked_up(self.grams(tongue, size), shards, width, taken, context, last, p)
        return -np.log(p), known

    def grams(self, tongue: str, size: int) -> Callable[[int], Iterator[tuple[bytes, bytes]]]:
        """How to read the packed contexts and n-grams of a shard of words."""
        return lambda number: zip(*self.packed(tongue, size, number, ["contexts", "grams"]), strict=True)

    def spelled_words(
        self, tongue: str, offsets: np.ndarray, data: np.ndarray, sums: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """Per word the numbers of those before it and its own, the surprise of its bytes and which text it is in.

        ``sums`` is the surprise of all bytes before each byte. A word's bytes are it and one space after it.
        """
        bounds = offsets - offsets[0]
        words, starts, ends = word_keys(offsets, data)
        text = np.searchsorted(bounds, starts, "right") - 1
        numbers = [x.astype(np.int32) for x in word_grams.numbered(words, self.words(tongue))]
        return *numbers, sums[np.minimum(ends + 1, bounds[text + 1])] - sums[starts], text.astype(np.int32)

    def worded(self, tongue: str, parts: list[tuple[np.ndarray, ...]], nll: np.ndarray, model: int) -> np.ndarray:
        """Per text the surprise of its words, of the words of some parts and the surprise of all bytes of each text."""
        *words, spelled, text = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        own, known = self.word_surprise(tongue, words, model)
        # A known word takes the place of its spelling.
        return nll + np.bincount(text, own - np.where(known, spelled, 0), len(nll))


_models: dict[str, Model] = {}


def model_of(folder: str) -> Model:
    if folder not in _models:
        _models.clear()
        _models[folder] = Model(folder)
    return _models[folder]


def words_in(folder: str) -> Callable[[str], tuple[np.ndarray, np.ndarray]]:
    """How a task looks up the words of a language."""
    return lambda lang: model_of(folder).words("l" + lang.encode().hex().upper())


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in longer ones of about GROUP bytes of text: a look-up passes over all shards of a language."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(x["text"].nbytes for x in held) + batch["text"].nbytes > GROUP:
            whole, held = as_one(held), [batch]
            yield whole
        else:
            held.append(batch)
    if held:
        whole, held = as_one(held), []
        yield whole


def as_one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.concat_batches(batches) if len(batches) > 1 else batches[0]


def without_models(work: Callable) -> Callable:
    """The same work, after which the task's worker holds no models."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            _models.clear()

    return released(of)


def score(folder: str) -> Callable:
    """Rows with lang, fold and text to the same rows with nll, held_nll, word_nll and bytes.

    nll is by the bytes of all trusted text, held_nll and word_nll by the models without the row's
    fold. Without a model they are null.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = model_of(folder)
        for whole in gathered(batches):
            for start, stop in slices(buffers(whole["text"])[0], GROUP):
                batch = whole.slice(start, stop - start)
                nll, held_nll, word_nll = np.full((3, batch.num_rows), np.nan)
                sizes = np.zeros(batch.num_rows, np.int64)
                for lang, fold, alike in of_each(batch, "lang", "fold"):
                    tongue = "l" + lang.encode().hex().upper()
                    offsets, data = buffers(batch["text"].take(pa.array(alike)))
                    sizes[alike] = np.diff(offsets)
                    models.only(tongue)
                    if not models.has(tongue, 0):
                        continue
                    held_out = [fold + 1] if models.has(tongue, fold + 1) else []
                    parts = []
                    for first, last in slices(offsets, PART):
                        rows, own = alike[first:last], offsets[first : last + 1]
                        bounds = own - own[0]
                        of_all, *held = models.spelling(tongue, own, data, [0, *held_out])
                        nll[rows] = np.diff(of_all[bounds])
                        if held:
                            held_nll[rows] = np.diff(held[0][bounds])
                            *words, text = models.spelled_words(tongue, own, data, held[0])
                            parts.append((*words, text + np.int32(first)))
                        of_all = held = None
                    offsets = data = None
                    # What bytes took is for the words now.
                    give_back()
                    if parts:
                        # All words at once: each look-up passes over all shards of the language.
                        word_nll[alike] = models.worded(tongue, parts, held_nll[alike], fold + 1)
                found = [pa.array(x, from_pandas=True) for x in (nll, held_nll, word_nll)]
                columns = [*batch.columns, *found, pa.array(sizes)]
                names = [*batch.schema.names, "nll", "held_nll", "word_nll", "bytes"]
                yield pa.RecordBatch.from_arrays(columns, names).drop_columns(["lang", "fold", "text"])

    return of


def texts_of(docs: DataFrame, *kept: Column) -> DataFrame:
    """lang, text and fold; copies of one text are in one fold."""
    lang = F.coalesce(F.col("lang"), F.lit("")).alias("lang")
    text = F.coalesce(F.col("text"), F.lit(""))
    fold = F.pmod(F.xxhash64(text), F.lit(FOLDS)).cast("int").alias("fold")
    return docs.select(*kept, lang, text.alias("text"), fold)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The doc_ids that are labelled good and not toxic, each once."""
    good = labels.filter("quality = 1 and toxic = 0 and doc_id is not null")
    return stored(good.select("doc_id").distinct(), "trusted")


def trusted_documents(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, lang, text and fold of the documents with one of these ids."""
    return texts_of(docs.join(sized(ids), "doc_id", "left_semi"), F.col("doc_id"))


def fitted(trusted: DataFrame, fit: int | None) -> DataFrame:
    """About ``fit`` of the trusted documents of each language, all where it has no more or fit is None.

    A hash of id and text draws each with the same chance, so a second run draws the same. The number of
    rows is ``fit`` give or take its square root, at any input size; rows that repeat id and text come
    or stay away together.
    """
    if fit is None:
        return trusted
    sizes = stored(trusted.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    draw = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << BITS) - 1)) / F.lit(float(1 << BITS))
    drawn = trusted.join(F.broadcast(sizes), "lang").filter(draw * F.col("rows") < fit)
    return drawn.select(*trusted.columns)


def log_perplexity(nll: str, mean: str) -> Column:
    """The mean surprise of a document's bytes and of PRIOR average ones."""
    return (F.col(nll) + PRIOR * F.col(mean)) / (F.col("bytes") + PRIOR)


def excess() -> Column:
    """How far a document's log perplexity lies above the mean, by bytes or by words, whichever is more."""
    return F.greatest(
        *[log_perplexity(f"{kind}_nll", f"{kind}_mean") - F.col(f"{kind}_mean") for kind in ("held", "word")]
    )


def limits(scores: DataFrame) -> DataFrame:
    """Per language the means of a byte and the limit of excess, from the scores of trusted documents.

    Documents are counted in steps of excess; no group is ordered as a whole.
    """
    known = scores.filter("nll is not null")

    def of_byte(nll: str) -> Column:
        return F.sum(nll) / F.greatest(F.sum(F.when(F.col(nll).isNotNull(), F.col("bytes"))), F.lit(1))

    own = [of_byte(f"{kind}_nll").alias(f"{kind}_mean") for kind in ("held", "word")]
    means = stored(known.groupBy("lang").agg(of_byte("nll").alias("mean"), *own), "means")
    steps = (
        known.filter("held_nll is not null")
        .join(F.broadcast(means), "lang")
        .select("lang", F.floor(excess() / STEP).cast("long").alias("step"))
        .groupBy("lang", "step")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = F.collect_list(F.struct("step", "n")).alias("steps")
    total = F.aggregate("steps", F.lit(0).cast("long"), lambda total, x: total + x.n)
    # One more than the trusted documents, so that of others like them as many lie within.
    wanted = F.least(F.ceil((total + 1) * QUANTILE), total)
    reached = F.aggregate(
        F.array_sort("steps"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("step")),
        lambda state, x: F.when(state.step.isNotNull(), state).otherwise(
            F.struct(
                (state.n + x.n).alias("n"), F.when(state.n + x.n >= wanted, x.step).alias("step")
            )
        ),
    )
    # The steps of a language are some tens of thousands: a byte's surprise over the width of one.
    ends = steps.groupBy("lang").agg(counted).select("lang", ((reached.step + 1) * STEP).alias("limit"))
    return means.join(ends, "lang", "left")


def judged(
    docs: DataFrame, labels: DataFrame, fit: int | None = None, columns: list[str] | None = None
) -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, with lang, bytes, perplexities, excess, limit and kept.

    ``columns`` are those that the row keeps, doc_id and lang among them; all for None. Each text is scored
    once: the scores are stored with the rows, and limits are taken from those of trusted documents.
    Models of each language are made of all its trusted documents, or of about ``fit`` of them, drawn by
    a hash of id and text: of n-grams of bytes, and of n-grams of words, in which a word that
    those texts lack is spelled by bytes. ``perplexity`` is by the bytes of all of them.
    ``held_perplexity``, by bytes, and ``word_perplexity`` are from those texts that are not in the
    document's own fold, so a trusted document is scored like any other. All are of a byte of the document together with PRIOR
    bytes of average trusted text. ``excess`` is how many times its language's mean the
    one or the other is, whichever is more. A document whose excess lies above the language's limit,
    a quantile of all trusted documents' own, is not kept. A null language is a language. Documents of
    a language without trusted text are kept, with null perplexities; if its trusted texts all lie in
    one fold, it has no limit and all are kept. Empty and null texts are kept. Rows that repeat are judged alike; an empty table gives no
    rows.
    """
    ids = trusted_ids(labels)
    sample = fitted(trusted_documents(docs, ids), fit)
    folder = fresh_dir(docs.sparkSession, "shards")
    row = F.struct(*[F.col(f"`{name}`") for name in columns or docs.columns]).alias("row")
    whole = docs.select(row).schema
    for name in ("nll", "held_nll", "word_nll"):
        whole = whole.add(name, "double")
    whole = whole.add("bytes", "long")
    with short_batches(docs.sparkSession):
        grams = stored(by_model(sample.mapInArrow(released(count_grams), GRAM_ROWS), Bytes(ORDER)), "grams")
        write_model(grams, Bytes(ORDER), folder)
        write_model(word_shards(sample, Words(WORDS), folder), Words(WORDS), folder)
        scored = stored(texts_of(docs, row).mapInArrow(without_models(score(folder)), whole), "scored")
    tongue = F.coalesce(F.col("row.lang"), F.lit(""))
    own = scored.select(
        F.col("row.doc_id").alias("doc_id"), tongue.alias("lang"), "nll", "held_nll", "word_nll", "bytes"
    ).join(sized(ids), "doc_id", "left_semi")
    limit = stored(limits(stored(own, "scores")), "limits")
    found = scored.withColumn("tongue", tongue).join(
        limit.withColumnRenamed("lang", "tongue"), "tongue", "left"
    )
    return found.select(
        "row",
        F.col("tongue").alias("lang"),
        "bytes",
        F.exp(log_perplexity("nll", "mean")).alias("perplexity"),
        F.exp(log_perplexity("held_nll", "held_mean")).alias("held_perplexity"),
        F.exp(log_perplexity("word_nll", "word_mean")).alias("word_perplexity"),
        F.exp(excess()).alias("excess"),
        F.exp("limit").alias("limit"),
        ((F.col("bytes") == 0) | F.coalesce(excess() <= F.col("limit"), F.lit(True))).alias("kept"),
    )


def good_documents(docs: DataFrame, labels: DataFrame, fit: int | None = None) -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, with all their columns.

    What is kept depends on language and text alone, so the scores are taken without the other columns,
    and the rows to drop are known by doc_id and a hash of both.
    """
    hashed = F.xxhash64(*[F.coalesce(docs[name], F.lit("")) for name in ("lang", "text")])
    marked = docs.select("doc_id", "lang", "text", hashed.alias("mark"))
    out = judged(marked, labels, fit, ["doc_id", "lang", "mark"]).filter("not kept")
    gone = sized(stored(out.select("row.doc_id", "row.mark").distinct(), "gone"))
    return docs.join(gone, docs.doc_id.eqNullSafe(gone.doc_id) & (hashed == gone.mark), "left_anti")
