"""Connected components of links between numbers, by contracting the links round by round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loglode.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node that links reach; one row per node of ``links`` (a, b).

    Every round each node joins its smallest neighbour, chains of joins are followed, and links are
    taken over to what their ends have joined. At least half of the nodes that still differ from a
    neighbour go each round, so rounds grow with the logarithm of the links. All steps are joins
    and grouped minima, which a node with very many links passes partly added up.
    """
    def both(frame: DataFrame) -> DataFrame:
        turned = frame.select(F.col("b").alias("a"), F.col("a").alias("b"))
        return frame.select("a", "b").unionByName(turned)

    left = stored(both(links.filter("a <> b")).distinct(), "links")
    labels = stored(
        links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
        .select("node", F.col("node").alias("component")),
        "labels",
    )
    while not left.isEmpty():
        joins = stored(
            left.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")), "joins"
        )
        while True:
            further = joins.select(F.col("a").alias("to"), F.col("to").alias("root"))
            step = stored(
                joins.join(further, "to").select("a", "to", "root"), "steps"
            )
            moved = not step.filter("`to` <> root").isEmpty()
            joins = step.select("a", F.col("root").alias("to"))
            if not moved:
                break
        named = joins.select(F.col("a").alias("component"), "to")
        labels = stored(
            labels.join(named, "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")
            ),
            "labels",
        )
        ends = joins.select(F.col("a").alias("b"), F.col("to").alias("b_to"))
        left = stored(
            left.join(joins, "a")
            .join(ends, "b")
            .filter("`to` <> b_to")
            .select(F.col("to").alias("a"), F.col("b_to").alias("b"))
            .distinct(),
            "links",
        )
    return labels
