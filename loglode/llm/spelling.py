"""Spelling variants by an index of variable-length grams: words one edit apart, and the form each stands for."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from loglode.llm.shingles import few_rows
from loglode.llm.tables import sized, stored

#: Code points of a word at least, and how often it must occur.
SHORTEST, OFTEN = 7, 2
#: Shortest and longest gram. A word with its two end signs has SHORTEST + 3 - SHORT grams at least,
#: more than one edit can touch, which is LONG at most; so words one edit apart share a gram.
SHORT, LONG = 3, 6
#: Grams of one length whose counts the dictionary may hold: a gram is in it, and grows, if it occurs
#: more often than the positions of all words over this number, and than RARE.
DICTIONARY, RARE = 100_000, 32
#: Words that are compared with each other in one list; longer lists are split.
LIST = 200
#: How many times as frequent a form must be.
TIMES = 10
#: Different words or grams that a task adds up before it passes them on.
HELD = 200_000
#: One in so many runs of letters, by hash, lacks a letter.
DAMAGED = 31
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def flushed(counts: Counter, name: str) -> pa.RecordBatch:
    columns = [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, [name, "n"])


def damaged(run: str, hashed: int) -> str:
    """The run, or without one letter for one hash in DAMAGED."""
    if hashed % DAMAGED:
        return run
    at = hashed % len(run)
    return run[:at] + run[at + 1 :]


def count_words(shortest: int) -> Callable:
    """doc_id and text to words and how often they occur, with one letter lost by hash."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in few_rows(batches, 500):
            texts = pc.ascii_lower(batch["text"].fill_null("")).to_pylist()
            for doc, text in zip(batch["doc_id"].fill_null("").to_pylist(), texts, strict=True):
                start = zlib.crc32(f"{doc}:".encode())
                for run, n in Counter(RUN.findall(text)).items():
                    if len(run) >= shortest:
                        word = damaged(run, zlib.crc32(run.encode(), start))
                        if len(word) >= shortest:
                            total[word] += n
                if len(total) > HELD:
                    yield flushed(total, "word")
                    total = Counter()
        yield flushed(total, "word")

    return of


def words_of(docs: DataFrame, shortest: int = SHORTEST, often: int = OFTEN) -> DataFrame:
    """word and n: the words of all texts that occur ``often`` at least."""
    rows = docs.select(F.col("doc_id").cast("string"), "text")
    counted = rows.mapInArrow(count_words(shortest), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often)


def signed(word: str) -> str:
    """The word between signs that no word holds, so that its ends are told apart."""
    return f"^{word}$"


def gram_end(text: str, at: int, dictionary: dict[str, int]) -> int:
    """Where the gram that starts at a place ends: it grows as long as it is frequent.

    Only its own letters decide, so an edit changes no gram but those that it touches.
    """
    end = at + SHORT
    while end - at < LONG and end < len(text) and text[at:end] in dictionary:
        end += 1
    return end


def grams(word: str, dictionary: dict[str, int]) -> list[tuple[int, int]]:
    """Start and end of the gram at each place of a word between its signs."""
    text = signed(word)
    return [(at, gram_end(text, at, dictionary)) for at in range(len(text) - SHORT + 1)]


def most_touched(found: list[tuple[int, int]], size: int) -> int:
    """How many of a word's grams one edit changes at most."""
    over = [0] * (size + 1)
    for start, end in found:
        over[start] += 1
        over[end] -= 1
    most = now = 0
    for change in over:
        now += change
        most = max(most, now)
    return most


def count_grams(length: int, dictionary: dict[str, int]) -> Callable:
    """Words to the grams of one length, whose shorter ones are frequent, and how often they occur."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for text in map(signed, batch["word"].to_pylist()):
                for at in range(len(text) - length + 1):
                    if length == SHORT or text[at : at + length - 1] in dictionary:
                        total[text[at : at + length]] += 1
                if len(total) > HELD:
                    yield flushed(total, "gram")
                    total = Counter()
        yield flushed(total, "gram")

    return of


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """The frequent grams with their counts, found length by length: only frequent ones grow.

    No more than DICTIONARY grams of a length can be frequent, so this fits in the driver and in tasks.
    """
    positions = words.agg(F.sum(F.length("word") + 3 - SHORT)).first()[0] or 0
    least = max(RARE, positions / DICTIONARY)
    dictionary: dict[str, int] = {}
    for length in range(SHORT, LONG + 1):
        counted = words.select("word").mapInArrow(count_grams(length, dictionary), "gram string, n long")
        frequent = counted.groupBy("gram").agg(F.sum("n").alias("n")).filter(F.col("n") > least)
        dictionary.update((row.gram, row.n) for row in frequent.collect())
    return dictionary


def list_keys(dictionary: dict[str, int]) -> Callable:
    """Words to the lists of the gram index in which they are merged.

    If one edit touches at most m of a word's grams, one of its m + 1 rarest is left as it is in the
    other word, so the longer lists need no merging. The edit lies to the right of that gram, and the
    words agree from their start to its end, or to the left, and they agree from its start on. So a
    list is named by a gram with all on the side where nothing changed; ``rest`` is the other side.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches, 5000):
            keys, rests, rows = [], [], []
            for row, word in enumerate(batch["word"].to_pylist()):
                text = signed(word)
                found = grams(word, dictionary)
                ranked = sorted((dictionary.get(text[a:b], 0), text[a:b], a, b) for a, b in found)
                chosen = ranked[: most_touched(found, len(text)) + 1]
                for end in {b for *_, b in chosen}:
                    keys.append(text[:end])
                    rests.append(text[end:])
                    rows.append(row)
                for start in {a for *_, a, _ in chosen}:
                    keys.append("<" + text[start:])
                    rests.append(text[:start])
                    rows.append(row)
            some = batch.take(pa.array(rows, pa.int64()))
            columns = [pa.array(keys, pa.string()), pa.array(rests, pa.string()), *some.columns]
            yield pa.RecordBatch.from_arrays(columns, ["key", "rest", *some.schema.names])

    return of


def shortened(text: str) -> Column:
    """A text, and the text without each of its letters in turn."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    without = F.transform(
        places,
        lambda at: F.concat(F.substring(text, F.lit(1), at - 1), F.substring(text, at + 1, F.length(text))),
    )
    return F.array_distinct(F.concat(F.array(F.col(text)), without))


def near_pairs(words: DataFrame) -> DataFrame:
    """a, b, a_n, b_n: each two words one inserted, deleted or replaced code point apart, once, a < b."""
    entries = words.mapInArrow(list_keys(gram_dictionary(words)), "key string, rest string, word string, n long")
    entries = stored(entries, "lists")
    long = stored(
        entries.groupBy("key").agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > LIST).select("key"),
        "long-lists",
    )
    lists = entries.select("key", "word", "n")
    if not long.isEmpty():
        # Rests one edit apart agree, at most one letter taken from each; so a list falls into short ones.
        marked = sized(long)
        lists = entries.join(marked, "key", "left_anti").select("key", "word", "n").unionByName(
            entries.join(marked, "key", "left_semi").select(
                "key", "word", "n", F.explode(shortened("rest")).alias("less")
            ).select(F.concat("key", F.lit("|"), "less").alias("key"), "word", "n")
        )
    a = lists.select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = lists.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"))
    close = F.abs(F.length("a") - F.length("b")) <= 1
    pairs = a.join(b, "key").filter((F.col("a") < F.col("b")) & close)
    return pairs.filter(F.levenshtein("a", "b", 1) == 1).select("a", "b", "a_n", "b_n").distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word and root of (word, form): forms followed to the last, in doubling steps.

    A form is TIMES as frequent as its word, so no chain has more steps than a count has digits.
    """
    roots = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(
            roots.join(on, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
            ),
            "roots",
        )
        roots = step.select("word", "root")
        if step.filter("moved").isEmpty():
            return roots


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: the words of all texts and the form each is a variant of.

    Words are runs of letters of SHORTEST code points at least that occur OFTEN times, A to Z in lower
    case; by a hash of doc_id and run, one run in DAMAGED first loses a letter. Two words are near if
    one inserted, deleted or replaced code point tells them apart. The form of a word is its most
    frequent near word (ties: the first in code-point order) if that is TIMES as frequent; ``root``
    follows forms to the last and is the word itself if it has none. A null text has no words, a null
    doc_id is hashed like no digits, rows that repeat count each, and an empty table gives no rows.
    Other columns are not used.

    Counts are added up in tasks before each shuffle. The gram dictionary has a size bound and goes to
    all tasks; all else is joins. A list of more than LIST words is split by what its words' rests are
    without one letter, so no list makes all its pairs.
    """
    words = stored(words_of(docs), "words")
    pairs = stored(near_pairs(words), "near")
    turned = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("b_n").alias("a_n"), F.col("a_n").alias("b_n"))
    largest = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("word")))
    near = (
        pairs.unionByName(turned)
        .groupBy(F.col("a").alias("word"))
        .agg(F.count(F.lit(1)).alias("n_near"), largest.alias("largest"), F.first("a_n").alias("own"))
    )
    enough = -F.col("largest.less") >= TIMES * F.col("own")
    near = stored(
        near.select(
            "word",
            "n_near",
            F.when(enough, F.col("largest.word")).alias("form"),
            F.when(enough, -F.col("largest.less")).alias("form_n"),
        ),
        "forms",
    )
    ends = roots(near.filter("form is not null"))
    return (
        words.join(near, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            "form_n",
        )
    )
