"""Language identification that weighs text, declared language, address and host against each other."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F, types as T

from loglode.llm.shingles import FOLD, buffers, few_rows, mixed, slices
from loglode.llm.tables import stored
from loglode.session import fresh_dir

#: Cells for the trigrams of bytes. The model has so many numbers per language at any input size.
CELLS = 1 << 16
#: Languages in a block of the model, 16 MB of it, and blocks that a worker keeps. Each group of texts
#: passes over all blocks; those beyond the kept ones are read for each group.
BLOCK, KEPT = 64, 4
#: Numbers of a group of texts, one per text and language.
NUMBERS = 1 << 21
#: Most tables of counts that a task holds.
TABLES = 64
#: Pseudo-counts: of a trigram, of evidence from declarations and suffixes, of the level above a host.
SMOOTH, EVIDENCE, HOST = 0.5, 1.0, 5.0
#: Neighbouring trigrams overlap, so a text counts for this share of what they would say alone, and
#: no text for more than this many of them.
SHARE, MOST = 0.3, 200.0
#: What the surest evidence leaves to the other languages.
FLOOR = 1e-6
HTML_LANG = r"(?is)<html[^>]*?\slang\s*=\s*[\"']?\s*([a-z]+)"
HIDDEN = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
HOST_OF = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)"
#: A language code as the first folder of an address.
FOLDER = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*/([a-z]{2})(?:[-_][a-z]{2})?(?:[/?#]|$)"


def page_rows(pages: DataFrame) -> DataFrame:
    """page_id, text, declared, suffix, host and site of each page.

    declared: the language that the html element names. suffix: the first folder of the address if
    it looks like a language code, else the last part of the host name. site: the last two parts of
    the host name. Null where there is none.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    url = F.coalesce(F.col("url"), F.lit(""))
    host = F.lower(F.regexp_extract(url, HOST_OF, 1))
    folder = F.lower(F.regexp_extract(url, FOLDER, 1))
    filled = lambda text: F.when(text != "", text)
    return pages.select(
        F.col("page_id").cast("long"),
        F.regexp_replace(html, HIDDEN, " ").alias("text"),
        filled(F.lower(F.regexp_extract(html, HTML_LANG, 1))).alias("declared"),
        F.coalesce(filled(folder), filled(F.substring_index(host, ".", -1))).alias("suffix"),
        filled(host).alias("host"),
        filled(F.substring_index(host, ".", -2)).alias("site"),
    )


def document_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and source of each document in the same form; a source is a host."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        none.alias("declared"),
        none.alias("suffix"),
        F.col("source").cast("string").alias("host"),
        none.alias("site"),
    )


def trigram_cells(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The cell of the three bytes that end at each byte; letters A-Z in lower case, zeros before a text."""
    begin = int(offsets[0])
    chars = FOLD[data[begin : int(offsets[-1])]].astype(np.uint64)
    packed = chars.copy()
    packed[1:] |= chars[:-1] << np.uint64(8)
    packed[2:] |= chars[:-2] << np.uint64(16)
    for place in range(2):
        # The bytes of the text before are none of this one's.
        at = offsets[:-1][np.diff(offsets) > place] - begin + place
        packed[at] &= np.uint64((1 << 8 * (place + 1)) - 1)
    return (mixed(packed) % np.uint64(CELLS)).astype(np.int64)


def count_cells(languages: list[str]) -> Callable:
    """lang and text to rows of a language's number and its counts of all cells."""
    numbers = {language: number for number, language in enumerate(languages)}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[int, np.ndarray] = {}
        for batch in batches:
            langs = batch["lang"].dictionary_encode()
            for at, language in enumerate(langs.dictionary.to_pylist()):
                alike = pa.array(langs.indices.to_numpy() == at)
                offsets, data = buffers(batch["text"].filter(alike))
                cells = np.zeros(CELLS, np.int64)
                for first, last in slices(offsets):
                    cells += np.bincount(trigram_cells(offsets[first : last + 1], data), minlength=CELLS)
                number = numbers[language]
                table[number] = table[number] + cells if number in table else cells
                if len(table) == TABLES:
                    yield numbered_cells(table)
                    table = {}
        yield numbered_cells(table)

    return of


def numbered_cells(table: dict[int, np.ndarray]) -> pa.RecordBatch:
    cells = [row.tobytes() for row in table.values()]
    return pa.record_batch([pa.array(list(table), pa.int32()), pa.array(cells, pa.binary())], ["at", "cells"])


def log_shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All counts of some languages to the logarithm of each cell's probability."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, cells in zip(batch["at"].to_pylist(), batch["cells"].to_pylist(), strict=True):
            row = np.frombuffer(cells, np.int64)
            sums[at] = sums[at] + row if at in sums else row
    for at, row in sums.items():
        row = row + SMOOTH
        yield numbered_cells({at: np.log(row / row.sum()).astype(np.float32)})


def text_model(labelled: DataFrame) -> tuple[list[str], str]:
    """Languages in order, and the folder with the logarithm of each cell's probability in each, from
    all rows, a row per language in blocks of BLOCK languages."""
    known = labelled.filter("lang is not null and lang <> ''").select("lang", "text")
    languages = sorted(row["lang"] for row in known.select("lang").distinct().collect())
    folder = fresh_dir(labelled.sparkSession, "languages")
    if languages:
        shape = "at int, cells binary"
        counts = known.mapInArrow(count_cells(languages), shape)
        model = counts.repartition(min(len(languages), TABLES), "at").mapInArrow(log_shares, shape)
        blocks = model.withColumn("block", F.floor(F.col("at") / BLOCK).cast("int"))
        blocks.write.partitionBy("block").parquet(folder)
    return languages, folder


class Blocks:
    """The model of a folder as a worker reads it, block by block."""

    def __init__(self, folder: str):
        self.store, place = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        self.files: dict[int, list[str]] = {}
        for info in self.store.get_file_info(fs.FileSelector(place, recursive=True)):
            if info.path.endswith(".parquet"):
                number = int(info.path.rsplit("block=", 1)[1].split("/", 1)[0])
                self.files.setdefault(number, []).append(info.path)
        self.kept: dict[int, dict[int, np.ndarray]] = {}

    def rows(self, number: int) -> dict[int, np.ndarray]:
        """The row of each language of a block."""
        if number in self.kept:
            return self.kept[number]
        found = {}
        for path in self.files[number]:
            table = pq.ParquetFile(self.store.open_input_file(path)).read(["at", "cells"], use_threads=False)
            for at, cells in zip(table["at"].to_pylist(), table["cells"].to_pylist(), strict=True):
                found[at] = np.frombuffer(cells, np.float32)
        if len(self.kept) < KEPT:
            self.kept[number] = found
        return found


_blocks: dict[str, Blocks] = {}


def blocks_of(folder: str) -> Blocks:
    if folder not in _blocks:
        _blocks.clear()
        _blocks[folder] = Blocks(folder)
    return _blocks[folder]


def text_evidence(folder: str, count: int) -> Callable:
    """Rows to the same without text, with the logarithm of each language's likelihood."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = blocks_of(folder)
        for batch in few_rows(batches, max(1, NUMBERS // count)):
            offsets, data = buffers(batch["text"])
            sums = np.zeros((count, batch.num_rows))
            for number in sorted(model.files):
                rows = model.rows(number)
                for first, last in slices(offsets):
                    some = offsets[first : last + 1]
                    cells = trigram_cells(some, data)
                    for at, row in rows.items():
                        total = np.concatenate([[0.0], np.cumsum(row[cells], dtype=np.float64)])
                        sums[at, first:last] = np.diff(total[some - some[0]])
            sizes = np.diff(offsets)
            weight = np.where(sizes > 0, np.minimum(SHARE * sizes, MOST) / np.maximum(sizes, 1), 0)
            likelihood = (sums - sums.max(axis=0)) * weight
            lists = pa.ListArray.from_arrays(
                np.arange(batch.num_rows + 1, dtype=np.int32) * count, likelihood.T.ravel()
            )
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, lists], [*rest.schema.names, "likelihood"])

    return of


def chances(logs: Column) -> Column:
    """Logarithms, the largest of them 0, to shares of one."""
    powers = F.transform(logs, F.exp)
    total = F.aggregate(powers, F.lit(0.0), lambda total, x: total + x)
    return F.transform(powers, lambda x: x / total)


def by_key(rows: DataFrame, *keys: str) -> DataFrame:
    """Per value of the first key, and of what it belongs to, the array n: how much of each language
    its rows hold."""
    some = rows.filter(F.col(keys[0]).isNotNull()) if keys else rows
    each = some.select(*keys, F.posexplode("chance").alias("at", "share"))
    sums = each.groupBy(*keys, "at").agg(F.sum("share").alias("n"))
    lists = sums.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("n"))
    return lists.withColumn("n", F.col("n.n"))


def shares(before: Column, weight: float) -> Column:
    """Smoothed shares of the languages in a group: its own sums and ``weight`` of those before."""
    total = F.aggregate("n", F.lit(weight), lambda total, x: total + x)
    return F.transform(F.zip_with("n", before, lambda n, x: n + weight * x), lambda x: x / total)


def logs(values: Column) -> Column:
    return F.transform(values, lambda x: F.log(F.greatest(x, F.lit(FLOOR))))


def identify(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """The rows without their text, with language, chance, text_language and chances.

    ``rows`` has text, declared, suffix, host and site, each of which may be null, beside columns
    that are handed on. ``labelled`` has lang and text; all its rows train the text model. The text's
    likelihoods come first. Summed by group they tell how far each declared language and each suffix
    speaks for a language, and how common the languages are on a host; a host with few rows is
    smoothed by its site, a site by all rows. The posterior adds up the logarithms of all of them.
    Evidence that a row lacks says nothing; an empty text leaves the rest to decide. Equal chances
    go to the first language in order. Without labelled rows the language is null. There may be any
    number of languages: the model lies in the shared folder in blocks of them.
    """
    languages, folder = text_model(labelled)
    kept = [name for name in rows.columns if name != "text"]
    if not languages:
        none = F.lit(None)
        return rows.select(
            *kept, none.cast("string").alias("language"), none.cast("double").alias("chance"),
            none.cast("string").alias("text_language"), none.cast("array<double>").alias("chances"),
        )
    names = F.array(*map(F.lit, languages))
    shape = rows.select(*kept).schema.add("likelihood", T.ArrayType(T.DoubleType()))
    count = len(languages)
    seen = stored(rows.mapInArrow(text_evidence(folder, count), shape), "likelihoods")
    seen = seen.withColumn("chance", chances(F.col("likelihood")))
    # One number per language; without rows there are none.
    alike = F.array_repeat(F.lit(1 / count), count)
    overall = by_key(seen).select(shares(alike, float(count)).alias("s")).first()
    common = F.array(*map(F.lit, overall["s"] if overall and overall["s"] else [1 / count] * count))

    def evidence(key: str) -> DataFrame:
        # P(value | language) but for a factor that all languages share.
        grown = F.zip_with(shares(common, EVIDENCE), common, lambda x, y: x / y)
        named = by_key(seen, key).select(F.col(key).alias(f"{key}_key"), logs(grown).alias(f"{key}_log"))
        return stored(named, key)

    sites = stored(by_key(seen, "site").select("site", shares(common, HOST).alias("above")), "sites")
    hosts = by_key(seen, "host", "site").join(sites, "site", "left")
    above = F.coalesce("above", common)
    hosts = stored(
        hosts.select(
            F.col("host").alias("host_key"),
            F.col("site").alias("site_key"),
            logs(shares(above, HOST)).alias("host_log"),
        ),
        "hosts",
    )
    found = seen
    for key in ("declared", "suffix"):
        found = found.join(evidence(key), F.col(key) == F.col(f"{key}_key"), "left")
    found = found.join(
        hosts, (F.col("host") == F.col("host_key")) & F.col("site").eqNullSafe(F.col("site_key")), "left"
    )
    zeros, prior = F.array_repeat(F.lit(0.0), count), logs(common)
    total = F.col("likelihood")
    for part in (
        F.coalesce("declared_log", zeros), F.coalesce("suffix_log", zeros), F.coalesce("host_log", prior)
    ):
        total = F.zip_with(total, part, lambda x, y: x + y)
    summed_up = found.withColumn("total", total)
    best = F.array_max("total")
    judged = summed_up.withColumn("chances", chances(F.transform("total", lambda x: x - best)))
    first = lambda values: names[F.array_position(values, F.array_max(values)).cast("int") - 1]
    return judged.select(
        *kept,
        first(F.col("chances")).alias("language"),
        F.array_max("chances").alias("chance"),
        first(F.col("likelihood")).alias("text_language"),
        "chances",
    )
