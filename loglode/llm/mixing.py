"""Mixing sources to target weights: how often each document is taken, by its source's rate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from loglode.llm.tables import WORD, numbered, stored

#: Weights of the sources in code point order, over and over.
WEIGHTS = (1.0, 2.0, 3.0)
#: Most times that a source, and a document, is repeated.
MOST = 3
SEED = 17


def words(text: Column) -> Column:
    """Number of words of a text; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """Per source: source, source_size and target.

    The sources share the sum of all sizes by weight. A target stops at ``most`` times its source;
    what is over goes to the others by weight, until no target is above. Only sums over the sources
    reach the driver. Null is a source of its own, the last one.
    """
    sizes = docs.groupBy("source").agg(F.sum(words(F.col("text"))).alias("source_size"))
    ranked = numbered(
        sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "place"
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    sources = stored(
        ranked.select(
            "source",
            "source_size",
            weight.alias("weight"),
            (F.col("source_size") * most).cast("double").alias("most"),
        ),
        "sources",
    )
    level = 0.0
    while True:
        full = F.col("most") <= F.col("weight") * F.lit(level)
        found = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not found["open"]:
            break
        # A target of weight * level never lies below that of the step before.
        above = max(level, (found["all"] - found["fixed"]) / found["open"])
        if above == level:
            break
        level = above
    target = F.least(F.col("most"), F.col("weight") * F.lit(level))
    return stored(sources.select("source", "source_size", target.alias("target")), "targets")


def with_copies(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, with size, source_size, target and copies.

    A source's rate is its target over its size. Each document is taken floor(rate) times, and once
    more with a probability of the rest, drawn by a hash of the seed, doc_id and text. So every run
    takes the same, and rows that repeat id and text are taken alike. A document without words
    counts for nothing in the sizes and is taken at its source's rate as well; where the whole
    source has no words the rate is 1. An empty table gives no rows.
    """
    targets = source_targets(docs, weights, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(1.0)
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "row.doc_id", "row.text"), 11) / F.lit(2.0**53)
    whole = F.floor("rate")
    copies = whole + F.when(drawn < F.col("rate") - whole, 1).otherwise(0)
    columns = [F.col(f"`{name}`") for name in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"))
    return (
        rows.join(targets, F.col("row.source").eqNullSafe(targets.source))
        .withColumn("rate", rate)
        .select(
            "row",
            words(F.col("row.text")).alias("size"),
            "source_size",
            "target",
            F.least(copies, F.lit(most)).cast("int").alias("copies"),
        )
    )


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents of the mix: each row of ``docs`` as often as it is taken, columns as they are."""
    taken = with_copies(docs, weights, most).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(
        "row.*"
    )
