"""Exact duplicates by naming blocks, then pairs of names, until one name is left per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loglode.llm.tables import ascii_lower, numbered, one_row_each, stored

#: Bytes in a block.
BLOCK = 16_384


def whole_texts(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, sha256, blocks (their number) and bytes of each lower-cased text."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("text") / size)).cast("int")
    return docs.select("doc_id", text.alias("text")).select(
        "doc_id",
        F.sha2("text", 256).alias("sha256"),
        count.alias("blocks"),
        F.col("text").cast("binary").alias("bytes"),
    )


def blocks_of(texts: DataFrame, size: int) -> DataFrame:
    """The columns of ``texts`` but bytes, with at, block and hash for each block."""
    pieces = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda i: F.substring(F.col("bytes"), i * size + 1, F.lit(size)),
    )
    kept = [name for name in texts.columns if name != "bytes"]
    cut = texts.select(*kept, F.posexplode(pieces).alias("at", "block"))
    return cut.withColumn("hash", F.xxhash64("block"))


def block_names(blocks: DataFrame, cut: DataFrame) -> DataFrame:
    """row, at and name: the place of the block among all different blocks, sorted.

    Equal blocks meet in one row before the shuffle, so a block that fills a third of the input
    moves once per task. The blocks are sorted by hash; where one hash has several blocks, and only
    there, the blocks themselves decide.
    """
    texts = F.count(F.lit(1)).alias("texts")
    hashes = stored(blocks.select("hash", "block").distinct().groupBy("hash").agg(texts), "hashes")
    several = hashes.filter("texts > 1").select("hash")
    order = hashes.filter("texts = 1").select("hash", F.lit(None).cast("binary").alias("block"))
    clash = not several.isEmpty()
    if clash:
        shared = blocks.join(several, "hash", "left_semi")
        order = order.unionByName(shared.select("hash", "block").distinct())
    names = numbered(order, ["hash", "block"], "name")
    out = cut.join(names.filter("block is null").drop("block"), "hash").select("row", "at", "name")
    if clash:
        key = ["doc_id", "sha256", "at"]
        parted = shared.join(names, ["hash", "block"]).select(*key, "name").distinct()
        out = out.unionByName(cut.join(parted, key).select("row", "at", "name"))
    return out


def pair_names(names: DataFrame) -> DataFrame:
    """One name for each two neighbours; equal pairs, and only they, get the same name."""
    even = F.col("at") % 2 == 0
    pairs = stored(
        names.groupBy("row", F.shiftright("at", 1).alias("at")).agg(
            F.min(F.when(even, F.col("name"))).alias("left"),
            F.coalesce(F.min(F.when(~even, F.col("name"))), F.lit(-1)).alias("right"),
        ),
        "pairs",
    )
    ordered = numbered(pairs.select("left", "right").distinct(), ["left", "right"], "name")
    return pairs.join(ordered, ["left", "right"]).select("row", "at", "name")


def identities(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: row, doc_id, sha256, blocks and name.

    Two rows have equal blocks and name exactly if their texts are equal after lower-casing A-Z.
    A null text is empty; it has one empty block. Any number of rows may be equal.
    """
    texts = whole_texts(docs, size)
    # The row numbers hold for this one stored table only; a second scan may number otherwise.
    rows = texts.withColumn("row", F.monotonically_increasing_id())
    cut = stored(blocks_of(rows, size).drop("block"), "cut")
    heads = cut.filter("at = 0").select("row", "doc_id", "sha256", "blocks")
    longest = heads.agg(F.max("blocks")).first()[0] or 1
    level = stored(block_names(blocks_of(texts, size), cut), "level")
    done, width = [], 1
    while width < longest:
        sizes = heads.select("row", "blocks")
        done.append(sizes.filter(f"blocks <= {width} and blocks > {width // 2}").join(level, "row"))
        level = stored(
            pair_names(sizes.filter(f"blocks > {width}").join(level, "row").drop("blocks")), "level"
        )
        width *= 2
    named = heads.select("row").join(level, "row").select("row", "name")
    for part in done:
        named = named.unionByName(part.select("row", "name"))
    return heads.join(named, "row")


def exact_groups(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of the rows with one text the one with the largest doc_id is kept; of rows that repeat that
    doc_id, one. A null doc_id counts as the smallest. An empty table gives no rows; other columns
    of ``docs`` are not used.
    """
    named = stored(identities(docs, size), "identities")
    groups = named.groupBy("blocks", "name").agg(
        F.max(F.struct(F.col("doc_id"), F.col("row"))).alias("best"),
        F.count(F.lit(1)).alias("group_size"),
    )
    # Stored, so that the join below has a shuffle of its own, in which a large group is split.
    groups = stored(groups, "groups")
    return named.join(groups, ["blocks", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.col("sha256").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns.

    A row is found again by its doc_id and the digest of its text; rows that repeat both are one.
    """
    kept = exact_groups(docs, size).filter("kept").select("doc_id", "text_sha256")
    return one_row_each(docs, stored(kept, "kept"))
