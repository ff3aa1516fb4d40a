"""Mixing sources to target weights."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from brute import ROWS
from loglode.llm.mixing import MOST, WEIGHTS, mixed, source_targets, with_copies


def plain_targets(sizes):
    """Shares by weight; what is over a source's limit is shared again until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > MOST * sizes[s]]
        if not over:
            return {**share, **fixed}
        fixed |= {s: float(MOST * sizes[s]) for s in over}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100},
    {"a": 1000, "b": 1, "c": 2, "d": 300, None: 7, "": 5, "Z": 40, "é": 2},
    {"a": 0, "b": 10, "c": 0},
    {"only": 12},
    {None: 3},
    {"a": 0},
])
def test_targets(spark, sizes):
    rows = [(source, "w " * size) for source, size in sizes.items()]
    got = source_targets(spark.createDataFrame(rows, "source string, text string")).collect()
    want = plain_targets(sizes)
    assert {r.source: r.source_size for r in got} == sizes
    for r in got:
        assert r.target == pytest.approx(want[r.source])


def test_copies(small, empty):
    found = with_copies(small)
    rows = found.collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r.size == len(brute.WORD.findall(r.row.text or "")) and 0 <= r.copies <= MOST
        rate = r.target / r.source_size if r.source_size else 1
        assert int(rate) <= r.copies <= int(rate) + 1
    again = Counter((r.row.doc_id, r.row.text, r.copies) for r in with_copies(small.repartition(5)).collect())
    assert again == Counter((r.row.doc_id, r.row.text, r.copies) for r in rows)
    taken = mixed(small)
    assert taken.columns == small.columns and taken.count() == sum(r.copies for r in rows)
    assert mixed(empty).count() == 0 and with_copies(empty).count() == 0


def test_taken_comes_near_target(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    sums = with_copies(docs).groupBy("row.source").agg(
        F.first("target").alias("target"), F.sum(F.col("size") * F.col("copies")).alias("taken")
    )
    for r in sums.collect():
        assert r.taken == pytest.approx(r.target, rel=0.25)
