"""Exact top-k inner products by a dual traversal of cover trees, one of the queries and one of the data."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from loglode.llm.tables import sized, stored, wider

#: Results per query, and which rows are queries.
TOP, EVERY = 5, 50
#: Vectors that the top of the tree is fitted on: a sample of bounded size, chosen by hash.
SAMPLE = 2048
#: Most cells, each around one of these; fewer while there are less than CELL_ROWS vectors for each.
CELLS, CELL_ROWS = 256, 4096
#: Vectors of a tree, and of a shard: what a task holds while queries pass by.
TREE, SHARD = 4096, 1 << 17
#: Queries of one tree, and queries that pass by one copy of a shard.
GROUP, SLICE = 1024, 1 << 19
#: Points of a leaf of data, and of queries; the least mean number of points per child, else a node of
#: data stays a leaf.
LEAF, QUERY_LEAF, FANOUT = 64, 8, 16
LOWEST, NO_ID = -(1 << 63), (1 << 63) - 1
#: Share of the product of two norms that bounds are widened by, for rounding.
SLACK = 1e-9


@dataclass
class Node:
    """Points start to end of a tree; all lie within ``radius`` of ``center``."""

    center: np.ndarray
    radius: float
    start: int
    end: int
    kids: list[Node] = field(default_factory=list)

    def __post_init__(self):
        self.norm = float(np.linalg.norm(self.center))


class CoverTree:
    """Rows of integers, in the order of the tree's leaves.

    A node of radius up to 2^i has children whose centres, its own among them, are more than 2^(i-1)
    apart and cover its points within that distance. Where points are so far from each other that
    children would hold but a few, the node is a leaf.
    """

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        self.points = vectors.astype(np.float64)
        self.leaf = leaf
        self.order: list[np.ndarray] = []
        self.size = 0
        every = np.arange(len(vectors))
        middle = self.points.mean(0)
        center = int(np.argmin(self.distances(every, middle)))
        self.root = self.grow(every, center, self.distances(every, self.points[center]))
        order = np.concatenate(self.order)
        self.points, self.vectors = self.points[order], vectors[order]
        self.ids, self.rows = ids[order], rows[order]
        self.norms = np.linalg.norm(self.points, axis=1)
        self.most = float(np.abs(self.points).max(initial=0))

    def distances(self, rows: np.ndarray, center: np.ndarray) -> np.ndarray:
        return np.sqrt(np.square(self.points[rows] - center).sum(1))

    def grow(self, rows: np.ndarray, center: int, dist: np.ndarray) -> Node:
        radius = float(dist.max())
        node = Node(self.points[center], radius, self.size, self.size + len(rows))
        groups = self.covered(rows, center, dist) if len(rows) > self.leaf and radius else None
        if groups is None:
            self.order.append(rows)
            self.size += len(rows)
        else:
            node.kids = [self.grow(*group) for group in groups]
        return node

    def covered(self, rows: np.ndarray, center: int, dist: np.ndarray) -> list[tuple] | None:
        """Children's points, centre and distances; None where there would be too many."""
        near = 2.0 ** (np.ceil(np.log2(dist.max())) - 1)
        most = max(2, len(rows) // min(FANOUT, self.leaf))
        groups: list[tuple] = []
        while len(rows):
            inside = dist <= near
            groups.append((rows[inside], center, dist[inside]))
            rows = rows[~inside]
            if len(groups) == most and len(rows):
                return None
            if len(rows):
                center = int(rows[0])
                dist = self.distances(rows, self.points[center])
        return groups


class Best:
    """The best ``top`` scores of each query so far, ids and scores, best first."""

    def __init__(self, least: np.ndarray, top: int):
        self.top = top
        self.scores = np.full((len(least), top), LOWEST)
        self.ids = np.full((len(least), top), NO_ID)
        self.found = np.zeros((len(least), top), bool)
        #: The score below which nothing is of use: the kth so far, here or before.
        self.worst = least.copy()

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, usable: np.ndarray) -> None:
        """Scores of some queries with some points."""
        limit = self.worst[rows, None]
        if scores.shape[1] > self.top:
            masked = np.where(usable, scores, LOWEST)
            limit = np.maximum(limit, np.partition(masked, -self.top, axis=1)[:, -self.top, None])
        query, point = np.nonzero(usable & (scores >= limit))
        if not len(query):
            return
        had, place = np.nonzero(self.found[rows])
        query_all = np.concatenate([had, query])
        score_all = np.concatenate([self.scores[rows[had], place], scores[query, point]])
        id_all = np.concatenate([self.ids[rows[had], place], ids[point]])
        # ~x falls as x rises and, unlike -x, is defined for the lowest number.
        order = np.lexsort([id_all, ~score_all, query_all])
        query_all = query_all[order]
        place = np.arange(len(order)) - np.searchsorted(query_all, query_all)
        kept = place < self.top
        to = rows[query_all[kept]], place[kept]
        self.scores[to], self.ids[to], self.found[to] = score_all[order][kept], id_all[order][kept], True
        full = rows[self.found[rows, -1]]
        self.worst[full] = np.maximum(self.worst[full], self.scores[full, -1])


def bound(q: Node, r: Node) -> float:
    """No product of a point of one and a point of the other is larger."""
    sizes = (q.norm + q.radius) * (r.norm + r.radius)
    return float(q.center @ r.center) + q.norm * r.radius + r.norm * q.radius + q.radius * r.radius + SLACK * sizes


def hopeful(queries: CoverTree, q: Node, r: Node, worst: np.ndarray) -> np.ndarray:
    """The queries of a leaf that a point of the other node may still concern."""
    points, norms = queries.points[q.start : q.end], queries.norms[q.start : q.end]
    most = points @ r.center + norms * (r.radius + SLACK * (r.norm + r.radius))
    return q.start + np.flatnonzero(most >= worst[q.start : q.end])


def products(queries: CoverTree, rows: np.ndarray, data: CoverTree, r: Node) -> np.ndarray:
    """Inner products as whole numbers; those beyond 64 bits become the last number there is."""
    some = slice(r.start, r.end)
    if queries.most * data.most * queries.points.shape[1] < 2**53:
        return (queries.points[rows] @ data.points[some].T).astype(np.int64)
    exact = queries.vectors[rows].astype(object) @ data.vectors[some].T.astype(object)
    return np.clip(exact, LOWEST + 1, NO_ID).astype(np.int64)


def search(queries: CoverTree, data: CoverTree, best: Best) -> None:
    """Visit pairs of nodes, the most promising first; pass over those that cannot reach any kth score."""
    waiting = [(bound(queries.root, data.root), queries.root, data.root)]
    while waiting:
        most, q, r = waiting.pop()
        if most < best.worst[q.start : q.end].min():
            continue
        if q.kids and (not r.kids or q.radius >= r.radius):
            waiting += [(bound(kid, r), kid, r) for kid in q.kids]
            continue
        rows = np.arange(q.start, q.end) if q.kids else hopeful(queries, q, r, best.worst)
        if r.kids and len(rows):
            waiting += sorted(((bound(q, kid), q, kid) for kid in r.kids), key=lambda pair: pair[0])
        elif len(rows):
            own = queries.rows[rows, None] == data.rows[r.start : r.end]
            best.add(rows, products(queries, rows, data, r), data.ids[r.start : r.end], ~own)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of equal length; shorter ones end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), max(width, int(lengths.max(initial=0)))), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def widened(vectors: np.ndarray, width: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))


def trees(parts: list[tuple[np.ndarray, ...]], size: int, leaf: int, width: int) -> list[tuple[CoverTree, np.ndarray]]:
    """Trees of consecutive rows, and the fourth array of each part in the order of the tree."""
    vectors = np.concatenate([widened(part[0], width) for part in parts])
    ids, rows, least = (np.concatenate([part[i] for part in parts]) for i in (1, 2, 3))
    made = []
    for at in range(0, len(ids), size):
        some = slice(at, at + size)
        tree = CoverTree(vectors[some], ids[some], rows[some], leaf)
        made.append((tree, least[some][np.concatenate(tree.order)]))
    return made


def searched(top: int):
    """Sorted rows of units, data before queries in each, to the best of each query in its unit."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts():
            for batch in batches:
                units, kinds = batch["unit"].to_numpy(), batch["kind"].to_numpy()
                cuts = np.flatnonzero((np.diff(units) != 0) | (np.diff(kinds) != 0)) + 1
                for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                    if b > a:
                        some = batch.slice(a, b - a)
                        ids = some["vec_id"].fill_null(NO_ID).to_numpy()
                        least = some["least"].fill_null(LOWEST).to_numpy()
                        yield units[a], kinds[a], (matrix(some["v"], 0), ids, some["rid"].to_numpy(), least)

        def answers(held: list[tuple], data: list[tuple]) -> Iterator[pa.RecordBatch]:
            width = max(part[0].shape[1] for part in held)
            width = max([width, *(tree.points.shape[1] for tree, _ in data)])
            for queries, least in trees(held, GROUP, QUERY_LEAF, width):
                best = Best(least, top)
                for tree, _ in data:
                    if tree.points.shape[1] < width:
                        tree = CoverTree(widened(tree.vectors, width), tree.ids, tree.rows)
                    search(queries, tree, best)
                query, place = np.nonzero(best.found)
                found = [queries.rows[query], best.ids[query, place], best.scores[query, place]]
                names = ["rid", "vec_id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names)

        for _, unit in groupby(parts(), key=lambda part: part[0]):
            held, data, count = [], [], 0
            for kind, same in groupby(unit, key=lambda part: part[1]):
                for _, _, part in same:
                    held.append(part)
                    count += len(part[1])
                    if kind == 1 and data and count >= GROUP:
                        yield from answers(held, data)
                        held, count = [], 0
                if kind == 0:
                    data = trees(held, TREE, LEAF, max(part[0].shape[1] for part in held))
                    held, count = [], 0
            if held and data:
                yield from answers(held, data)

    return of


def placed(centers: np.ndarray):
    """Rows with the nearest centre and the distance to it."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch["v"], centers.shape[1]).astype(np.float64)
            wide = widened(centers, vectors.shape[1])
            cell, dist = np.zeros(len(vectors), np.int32), np.full(len(vectors), np.inf)
            for number, center in enumerate(wide):
                own = np.sqrt(np.square(vectors - center).sum(1))
                nearer = own < dist
                cell[nearer], dist[nearer] = number, own[nearer]
            columns = [*batch.columns, pa.array(cell), pa.array(dist)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "cell", "dist"])

    return of


def reached(centers: np.ndarray, radii: np.ndarray):
    """Queries to rows of query and cell, for each cell but the own that may hold something of use."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch["v"], centers.shape[1]).astype(np.float64)
            wide = widened(centers, vectors.shape[1])
            norms, far = np.linalg.norm(vectors, axis=1)[:, None], np.linalg.norm(wide, axis=1) + radii
            limit = vectors @ wide.T + norms * (radii + SLACK * far)
            least = batch["least"].fill_null(LOWEST).to_numpy()
            use = limit >= least[:, None]
            use[np.arange(len(use)), batch["cell"].to_numpy()] = False
            row, cell = np.nonzero(use)
            some = batch.take(pa.array(row)).drop_columns(["cell"])
            yield pa.RecordBatch.from_arrays(
                [*some.columns, pa.array(cell.astype(np.int32))], [*some.schema.names, "cell"]
            )

    return of


def spread_centers(sample: np.ndarray, count: int) -> np.ndarray:
    """Points far from each other: the top of a cover tree, always the farthest one next."""
    chosen = [0]
    points = sample.astype(np.float64)
    dist = np.square(points - points[0]).sum(1)
    while len(chosen) < count and dist.max() > 0:
        chosen.append(int(dist.argmax()))
        dist = np.minimum(dist, np.square(points - points[chosen[-1]]).sum(1))
    return points[chosen]


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and v, the components times ``scale`` rounded down, of the vectors that take part."""
    def is_number(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return vectors.filter(F.col("embedding").isNotNull() & F.forall("embedding", is_number)).select(
        F.col("vec_id").cast("long"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"),
    )


def nearest(vectors: DataFrame, top: int = TOP, every: int = EVERY, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` largest inner products of each query, exact.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows but the
    query's own. Components are multiplied by ``scale`` and rounded down. Equal scores are ordered by
    vec_id, a null one last (the largest long is taken for a null). Vectors that are null or hold a
    null or a number that is not finite take no part; of different lengths, the shorter ones end in
    zeros; an empty one scores 0. Scores beyond 64 bits are the largest long. Rows that repeat are rows
    of their own. An empty table, or one without queries, gives no rows. Other columns are not used.

    The top of the tree, at most CELLS centres, is fitted on SAMPLE vectors; every vector goes to its
    nearest centre. A cell is split by hash into shards of up to SHARD rows, so a crowded one is many
    tasks. Queries first visit the shards of their own cell. The kth score found there and the cells'
    covering radii tell which other cells each query must visit, so queries travel, in rows; a shard
    is copied for every SLICE queries. In a task trees of TREE data rows and of GROUP queries are
    traversed together. Where all is far from all, as in many dimensions, nothing can be passed over
    and the work is queries times rows, as for any exact method.
    """
    names = ["query_id", "rank", "vec_id", "score"]
    rows = stored(whole_numbers(vectors, scale).withColumn("rid", F.monotonically_increasing_id()), "vectors")
    is_query = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    total, asked = rows.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    if not asked:
        return rows.select(F.col("vec_id").alias(names[0]), F.lit(0).alias(names[1]), "vec_id", F.col("vec_id").alias(names[3])).limit(0)
    sample = rows.select("v", "rid").orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE).collect()
    width = max(len(row.v) for row in sample)
    points = np.array([[*row.v, *[0] * (width - len(row.v))] for row in sample], np.int64)
    centers = spread_centers(points.reshape(len(sample), width), max(1, min(CELLS, total // CELL_ROWS)))
    cells = stored(rows.mapInArrow(placed(centers), wider(rows, cell="integer", dist="double")), "cells")
    # One row per cell.
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("radius")).collect()
    radii = np.full(len(centers), -np.inf)
    shard = max(TREE, min(SHARD, total // 128))
    shards, first = [], 0
    for row in sorted(sizes):
        radii[row.cell] = row.radius
        shards.append((row.cell, first, count := -(-row.n // shard)))
        first += count
    copies = -(-asked // SLICE)
    deal = F.broadcast(rows.sparkSession.createDataFrame(shards, "cell int, first int, shards int"))
    turn = F.pmod(F.xxhash64("rid"), F.lit(copies)).cast("int")

    def unit(number: Column, copy: Column) -> Column:
        return ((F.col("first") + number) * copies + copy).alias("unit")

    own = F.pmod(F.xxhash64("rid", F.lit(1)), F.col("shards")).cast("int")
    carried = ["rid", "vec_id", "v", "cell", "dist"]
    nothing = F.lit(None).cast("long").alias("least")
    data = cells.join(deal, "cell").select(
        *carried, nothing, F.lit(0).alias("kind"), "first", own.alias("number"),
        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"),
    ).select("*", unit(F.col("number"), F.col("copy"))).drop("first", "number", "copy")

    def visits(queries: DataFrame) -> DataFrame:
        numbers = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("number")
        asked_at = queries.join(deal, "cell").select(*carried, "least", F.lit(1).alias("kind"), "first", numbers)
        asked_at = asked_at.select("*", unit(F.col("number"), turn)).drop("first", "number")
        ordered = data.unionByName(asked_at).repartition("unit").sortWithinPartitions("unit", "kind", "cell", "dist")
        return ordered.mapInArrow(searched(top), "rid long, vec_id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        place = Window.partitionBy("rid").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)

    queries = cells.filter(is_query)
    home = stored(ranked(visits(queries.withColumn("least", nothing))), "home")
    least = home.filter(F.col("rank") == top).select("rid", F.col("score").alias("least"))
    asking = queries.join(sized(least), "rid", "left").select(*carried, "least")
    away = asking.mapInArrow(reached(centers, radii), wider(asking.drop("cell"), cell="integer"))
    found = home.drop("rank").unionByName(visits(away))
    query_id = queries.select("rid", F.col("vec_id").alias("query_id"))
    vec_id = F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id")
    return ranked(found).join(query_id, "rid").select("query_id", "rank", vec_id, "score")
