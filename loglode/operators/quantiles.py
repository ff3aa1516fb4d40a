"""Exact interpolated quantiles without gathering a group in one place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def value_counts(rows: DataFrame, value: str, by: list[str]) -> DataFrame:
    """One row per group and distinct value with ``n``, its count; repeats fold before the shuffle."""
    return rows.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def cell(value: Column) -> Column:
    """A number that never falls as the value grows, in steps of about one percent.

    There are at most some 270 000 cells, whatever the data.
    """
    size = F.floor(F.log2(F.abs(value)) * 64) + 100_000
    endless = F.abs(value) == F.lit(float("inf"))
    size = F.when(F.isnan(value), 500_000).when(endless, 400_000).otherwise(size)
    return F.when(value == 0, 0).when(value < 0, -size).otherwise(size).cast("bigint")


#: Equal parts that a cell is cut into before its values are ordered.
PARTS = 1 << 16


def exact_quantiles(
    counts: DataFrame, value: str, names: dict[str, float], by: list[str]
) -> DataFrame:
    """Quantiles from ``value_counts``, interpolated between neighbours; one column per name.

    Counts per cell show which cells hold the wanted ranks. Those are cut into PARTS equal parts
    between their least and largest value, counted again, and only parts that hold a wanted rank are
    ordered value by value. So no task sees a group's values, just its cells, the parts of a cell or
    the values of a part: of the clock times of a month in milliseconds, some 40 000.
    """
    # Missing values stay in, in a cell of their own that counts for nothing: a filter would make
    # the two uses of the counts differ, and Spark would work them out twice.
    known = counts.withColumn("_cell", cell(F.col(value)))
    weight = F.when(F.col(value).isNotNull(), F.col("n"))
    cells = known.groupBy(*by, "_cell").agg(
        F.coalesce(F.sum(weight), F.lit(0)).alias("_size"),
        F.min(value).alias("_low"),
        F.max(value).alias("_high"),
    )
    group = Window.partitionBy(*by)
    cells = cells.select(
        *by,
        "_cell",
        "_low",
        "_high",
        "_size",
        _before("_size", group.orderBy("_cell")).alias("_below"),
        F.sum("_size").over(group).alias("_total"),
    )
    inside = _matched(known, cells.where(_holds(names)), [*by, "_cell"], ["_low", "_high", "_below", "_total"])
    share = (F.col(value) - F.col("_low")) / F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0))
    # Without a finite width the cell is one part.
    part = F.when(share.between(0.0, 1.0), F.floor(share * PARTS)).otherwise(0)
    inside = inside.withColumn("_part", F.coalesce(part, F.lit(0)).cast("bigint")).drop("_low", "_high")
    parts = inside.groupBy(*by, "_cell", "_part").agg(
        F.sum(weight).alias("_size"), F.max("_below").alias("_start"), F.max("_total").alias("_total")
    )
    order = Window.partitionBy(*by, "_cell").orderBy("_part")
    parts = parts.withColumn("_below", F.col("_start") + _before("_size", order))
    wanted = parts.where(_holds(names))
    ordered = _matched(
        inside.drop("_below", "_total"), wanted, [*by, "_cell", "_part"], ["_below", "_total"]
    )
    within = Window.partitionBy(*by, "_cell", "_part").orderBy(value)
    upto = F.col("_below") + F.sum("n").over(within.rowsBetween(Window.unboundedPreceding, 0))
    ordered = ordered.withColumn("_upto", upto)

    def at(rank: Column) -> Column:
        return F.max(
            F.when((rank >= F.col("_upto") - F.col("n")) & (rank < F.col("_upto")), F.col(value))
        )

    out = []
    for name, share_of_ranks in names.items():
        position, low, high = _ranks(share_of_ranks)
        share_of_high = F.max(position - low)
        out.append((at(low) + share_of_high * (at(high) - at(low))).alias(name))
    return ordered.groupBy(*by).agg(*out)


def _ranks(share: float) -> tuple[Column, Column, Column]:
    position = F.lit(share) * (F.col("_total") - 1)
    return position, F.floor(position), F.ceil(position)


def _holds(names: dict[str, float]) -> Column:
    """Whether a run of _size values after _below others has one of the wanted ranks."""
    found = F.lit(False)
    for share in names.values():
        for rank in _ranks(share)[1:]:
            found = found | ((rank >= F.col("_below")) & (rank < F.col("_below") + F.col("_size")))
    return found


def _before(size: str, order) -> Column:
    return F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def _matched(rows: DataFrame, wanted: DataFrame, key: list[str], extra: list[str]) -> DataFrame:
    """The rows whose key, nulls included, is among the wanted, with columns of those."""
    named = wanted.select(*[F.col(name).alias(f"_by_{name}") for name in key], *extra)
    match = F.lit(True)
    for name in key:
        match = match & F.col(name).eqNullSafe(F.col(f"_by_{name}"))
    return rows.join(named, match).drop(*[f"_by_{name}" for name in key])


def sketch_quantiles(
    rows: DataFrame, value: str, names: dict[str, float], by: list[str], accuracy: int = 10_000
) -> DataFrame:
    """Quantiles from a sketch of bounded size; off by at most 1/accuracy of the ranks."""
    return rows.groupBy(*by).agg(
        *[F.percentile_approx(value, share, accuracy).alias(name) for name, share in names.items()]
    )
