"""Near duplicates by an n-gram Jaccard join with rare-first prefix filtering."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from loglode.llm.components import components
from loglode.llm.shingles import few_rows, mixed, released, shingle_sets
from loglode.llm.tables import ascii_lower, sized, stored

#: Cells of the table of shingle counts, and cells in one row of it. The table has 8 MB at any
#: input size; shingles that share a cell only make the order of a few less good.
CELLS, ROW = 1 << 20, 1 << 12
#: Ranges of shingles whose sizes bound how far two sets differ.
PARTS = 128
SETS = "doc_id long, n long, set binary"


def signatures(words: int) -> Callable:
    """doc_id and text to doc_id, n_shingles and a 128-bit digest of the set (null if empty)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            sizes, digests = [], []
            for found in shingle_sets(batch["text"], words):
                sizes.append(len(found))
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                digests.append(digest if len(found) else None)
            columns = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "n_shingles", "digest"])

    return of


def counts_in_task(words: int) -> Callable:
    """Texts to the rows of a table of how many sets each cell's shingles are in."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            some, size = [], 0
            for found in shingle_sets(batch["text"], words):
                some.append(found)
                size += len(found)
                if size > 250_000:
                    cells += counted(some)
                    some, size = [], 0
            if some:
                cells += counted(some)
        yield table_rows(dict(enumerate(cells.reshape(-1, ROW))))

    return of


def counted(sets: list[np.ndarray]) -> np.ndarray:
    return np.bincount((np.concatenate(sets) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)


def table_rows(rows: dict[int, np.ndarray]) -> pa.RecordBatch:
    cells = [np.minimum(row, 2**32 - 1).astype("<u4").tobytes() for row in rows.values()]
    return pa.record_batch([pa.array(list(rows), pa.int32()), pa.array(cells, pa.binary())], ["at", "cells"])


def added_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of the table rows of a task, by place."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, cells in zip(batch["at"].to_pylist(), batch["cells"].to_pylist(), strict=True):
            row = np.frombuffer(cells, "<u4").astype(np.int64)
            sums[at] = sums[at] + row if at in sums else row
    yield table_rows(sums)


def shingle_counts(docs: DataFrame, words: int) -> Broadcast:
    """How many documents have the shingles of each cell, over all documents."""
    shape = "at int, cells binary"
    rows = docs.select("text").mapInArrow(released(counts_in_task(words)), shape)
    table = np.zeros((CELLS // ROW, ROW), np.int64)
    for row in rows.repartition(CELLS // ROW // 8, "at").mapInArrow(added_rows, shape).collect():
        table[row["at"]] += np.frombuffer(row["cells"], "<u4")
    return docs.sparkSession.sparkContext.broadcast(table.astype(np.uint32).ravel())


def prefixes(words: int, percent: int, counts: Broadcast) -> Callable:
    """doc_id and text to doc_id, n, the prefix, rarest shingle first, and the sizes of the parts.

    Of n shingles the n - ceil(t n) + 1 rarest are the prefix: two sets with a similarity of t or
    more share one of them.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for batch in few_rows(batches):
            sizes, rare, parts = [], [], []
            for found in shingle_sets(batch["text"], words):
                n = len(found)
                sizes.append(n)
                length = n + (-percent * n) // 100 + 1 if n else 0
                often = table[(found % np.uint64(CELLS)).astype(np.int64)]
                rare.append(found[np.lexsort((found, often))[:length]].view(np.int64))
                part = np.bincount((mixed(found) >> np.uint64(57)).astype(np.int64), minlength=PARTS)
                parts.append(np.minimum(part, 255).astype(np.uint8).tobytes())
            lists = pa.ListArray.from_arrays(
                np.cumsum([0, *map(len, rare)]).astype(np.int32),
                np.concatenate(rare) if rare else np.zeros(0, np.int64),
            )
            columns = [batch["doc_id"], pa.array(sizes, pa.int64()), lists, pa.array(parts, pa.binary())]
            yield pa.record_batch(columns, ["doc_id", "n", "prefix", "parts"])

    return of


def sets_of(words: int) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches, 200):
            found = list(shingle_sets(batch["text"], words))
            sizes = pa.array(map(len, found), pa.int64())
            sets = pa.array([x.tobytes() for x in found], pa.binary())
            yield pa.record_batch([batch["doc_id"], sizes, sets], ["doc_id", "n", "set"])

    return of


def alike(percent: int) -> Callable:
    """Pairs with both sets to the pairs that are similar enough."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch["a_set"], batch["b_set"], strict=True):
                x = np.frombuffer(a.as_buffer(), np.uint64)
                y = np.frombuffer(b.as_buffer(), np.uint64)
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return of


def enough(overlap: Column, sizes: Column, percent: int) -> Column:
    """Whether sets of these sizes in all, sharing so many shingles, are similar enough."""
    return overlap * (100 + percent) >= sizes * percent


def fitting(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs that pass the length and the positional filter.

    With the shared shingle at places p and q of sets of n and m, no more than n - p and m - q
    shingles are shared, provided that it is the first one that both have; the pair comes up again
    at that one.
    """
    shortest = F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent
    most = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at"))
    kept = pairs.filter(shortest & enough(most, F.col("a_n") + F.col("b_n"), percent))
    return kept.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def size_range(n: Column, percent: int) -> Column:
    """A number that grows with the size of a set; those of sizes that may link are neighbours or equal."""
    if percent >= 100:
        return n.cast("long")
    return F.floor(F.log(n.cast("double")) / math.log(100 / percent))


def across(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of one list, not of one component, that can pass the filters of ``fitting``.

    With the shared shingle at place p of n, a set links with sets of no more than ``most`` shingles. So of
    any pair the smaller set has its own size within its ``most``, which takes the shared shingle among its
    very first: most members of a long list have it near the end of their prefix, and are never paired
    with each other. What is left meets by list and range of sizes: first components, by the bounds of
    their members, then the members.
    """
    most = F.expr(f"(n - at) * {100 + percent} div {percent} - n")
    placed = stored(members.withColumn("most", most).withColumn("sizes", size_range(F.col("n"), percent)), "members")
    upto = size_range(F.col("most"), percent)
    early = stored(
        placed.filter("n <= most").withColumn("sizes", F.explode(F.sequence("sizes", upto))), "early"
    )

    def named(frame: DataFrame, side: str) -> DataFrame:
        kept = [F.col(x).alias(f"{side}_{x}") for x in frame.columns if x not in ("shingle", "sizes")]
        return frame.select("shingle", "sizes", *kept)

    def bounds(frame: DataFrame) -> DataFrame:
        return frame.groupBy("shingle", "sizes", "label").agg(F.min("n").alias("n"), F.max("most").alias("most"))

    fit = "a_n <= b_most and b_n <= a_most"
    meeting = stored(
        named(bounds(early), "a").join(named(bounds(placed), "b"), ["shingle", "sizes"])
        .filter(f"a_label <> b_label and {fit}")
        .select("shingle", "sizes", "a_label", "b_label"),
        "meeting",
    )
    smaller, larger = [
        named(frame.select("shingle", "sizes", "label", F.col("doc_id").alias(""), "n", "at", "most"), side)
        for frame, side in ((early, "a"), (placed, "b"))
    ]
    pairs = (
        smaller.join(meeting, ["shingle", "sizes", "a_label"])
        .join(larger, ["shingle", "sizes", "b_label"])
        .filter(f"{fit} and (a_n < b_n or a_n = b_n and a_ < b_)")
    )
    return pairs.select(F.col("a_").alias("a"), "a_n", "a_at", F.col("b_").alias("b"), "b_n", "b_at")


def close(percent: int) -> Callable:
    """Pairs with sizes and part sizes to the pairs that pass the suffix filter.

    Sets differ in no fewer shingles than the sizes of their parts differ in all.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [
                np.frombuffer(b"".join(batch[name].to_pylist()), np.uint8).reshape(-1, PARTS)
                for name in ("a_parts", "b_parts")
            ]
            differ = np.abs(sides[0].astype(np.int64) - sides[1]).sum(axis=1)
            sizes = batch["a_n"].to_numpy() + batch["b_n"].to_numpy()
            fit = (sizes - differ) * (100 + percent) >= 2 * percent * sizes
            pairs = pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"])
            yield pairs.filter(pa.array(fit))

    return of


def verified(
    pairs: DataFrame, rare: DataFrame, texts: DataFrame, words: int, percent: int
) -> DataFrame:
    """The pairs whose whole sets are similar enough; each pair is compared once."""
    of = rare.select("doc_id", "n", "parts")
    sides = {
        side: of.select(*[F.col(name).alias(f"{side}_{name}") for name in of.columns])
        for side in "ab"
    }
    near = pairs.join(sides["a"], F.col("a") == F.col("a_doc_id")).join(
        sides["b"], F.col("b") == F.col("b_doc_id")
    )
    columns = near.select("a", "b", "a_n", "b_n", "a_parts", "b_parts")
    near = stored(columns.mapInArrow(released(close(percent)), "a long, b long").distinct(), "pairs")
    wanted = stored(near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct(), "wanted")
    sets = stored(
        texts.join(sized(wanted), "doc_id", "left_semi").mapInArrow(released(sets_of(words)), SETS), "sets"
    )
    first = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("a_set"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("b_set"))
    both = near.join(first, "a").join(second, "b").select("a", "b", "a_set", "b_set")
    return stored(both.mapInArrow(released(alike(percent)), "a long, b long"), "verified")


def similar_links(
    classes: DataFrame, texts: DataFrame, words: int, percent: int
) -> DataFrame:
    """Links (a, b) between the documents of ``classes`` that join all that are similar enough.

    Documents that share a prefix shingle form its list. First every document of a list is compared
    with one hub, the document in which that shingle is rarest of all; so a group of thousands of
    near copies takes one comparison each. Then only lists that are not yet connected are left, and
    there every document is compared with all of the list that are in another component and that its size
    and place allow (``across``). Two similar documents are thus linked or already connected.
    """
    counts = shingle_counts(texts, words)
    shape = "doc_id long, n long, prefix array<long>, parts binary"
    rare = stored(
        texts.mapInArrow(released(prefixes(words, percent, counts)), shape).join(sized(classes), "doc_id", "left_semi"),
        "prefixes",
    )
    places = rare.select("doc_id", F.col("n").cast("int").alias("n"), F.posexplode("prefix").alias("at", "shingle"))
    members = places.groupBy("shingle").agg(F.count(F.lit(1)).alias("members"))
    shared = stored(members.filter("members > 1").select("shingle"), "shared")
    # Most prefix shingles are in one document only and go here.
    lists = stored(places.join(sized(shared), "shingle", "left_semi"), "places")
    hubs = stored(lists.groupBy("shingle").agg(F.min(F.struct("at", "n", "doc_id")).alias("hub")), "hubs")
    lists = stored(lists.join(hubs, "shingle"), "lists")
    to_hub = lists.filter("doc_id <> hub.doc_id").select(
        F.col("doc_id").alias("a"), F.col("n").alias("a_n"), F.col("at").alias("a_at"),
        F.col("hub.doc_id").alias("b"), F.col("hub.n").alias("b_n"), F.col("hub.at").alias("b_at"),
    )
    first = verified(fitting(to_hub, percent), rare, texts, words, percent)
    known = components(first)

    def labelled(frame: DataFrame, column: str, label: str) -> DataFrame:
        names = known.select(F.col("node").alias(column), F.col("component").alias(label))
        return frame.join(names, column, "left").withColumn(label, F.coalesce(label, column))

    open_lists = labelled(lists, "doc_id", "label").withColumn("hub_id", F.col("hub.doc_id"))
    open_lists = stored(
        labelled(open_lists, "hub_id", "hub_label").select(
            "shingle", "doc_id", "n", "at", "label", "hub_label", (F.col("doc_id") == F.col("hub_id")).alias("is_hub")
        ),
        "labelled",
    )
    open_shingles = stored(open_lists.filter("label <> hub_label").select("shingle").distinct(), "open")
    members = open_lists.join(sized(open_shingles), "shingle", "left_semi").filter("not is_hub")
    second = verified(fitting(across(members, percent), percent), rare, texts, words, percent)
    return first.unionByName(second)


def near_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, digest.

    A document's set are its distinct shingles of some words, split at ASCII white space after
    lower-casing A-Z; fewer words are one shingle. Two documents link when 100 times what both have
    is no less than ``percent`` times what either has; a document without words has no link.
    component_id is the smallest doc_id that links reach.

    Documents with equal sets are one until the end, named by the smallest doc_id. Rows that share a
    doc_id are one node, which links where any of their texts does. A null doc_id links with nothing
    and gets a null component_id. An empty table gives no rows; other columns are not used.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    rows = stored(
        texts.mapInArrow(released(signatures(words)), "doc_id long, n_shingles long, digest binary"), "signatures"
    )
    joined = rows.filter("doc_id is not null and digest is not null")
    # Stored, so that the join has a shuffle of its own, in which a large class is split.
    classes = stored(joined.groupBy("digest").agg(F.min("doc_id").alias("class")), "digests")
    named = stored(joined.join(classes, "digest").select("doc_id", "class").distinct(), "classes")
    several = named.groupBy("doc_id").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    same = named.join(several, "doc_id", "left_semi").select(
        F.col("doc_id").alias("a"), F.col("class").alias("b")
    )
    nodes = stored(named.select(F.col("class").alias("doc_id")).distinct(), "nodes")
    links = similar_links(nodes, texts.filter("doc_id is not null"), words, percent)
    labels = components(links.unionByName(same))
    groups = named.groupBy("doc_id").agg(F.min("class").alias("class")).join(
        labels.withColumnRenamed("node", "class"), "class", "left"
    )
    groups = groups.select("doc_id", F.coalesce("component", "class").alias("component"))
    return rows.join(groups, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), "digest"
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the component_id, with all their columns.

    Rows without words stay; so do those with a null doc_id.
    """
    groups = near_groups(docs, words, percent)
    gone = stored(groups.filter("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return docs.join(sized(gone), "doc_id", "left_anti")
