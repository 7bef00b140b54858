"""Approximate nearest neighbours by vantage-point trees, one per shard."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgestar.session import stage

NEIGHBOURS = 10
#: A shard holds so many rows times the root of their number, so that rows and copies of queries grow
#: alike, until it holds ``SHARD_VALUES`` components.
SHARD = 32
SHARD_VALUES = 4_000_000
#: Queries that go down a tree together.
QUERIES = 2_048
LEAF = 256
#: Factor of pruning: a part is skipped if its distance bound times FACTOR exceeds the worst
#: neighbour so far. 1 is exact; larger values skip more.
FACTOR = 1.0
_SLACK = 1e-9


@dataclass
class Node:
    """Points in a ball and outside it, or the points of a leaf."""

    point: int = -1
    radius: float = 0.0
    inside: Node | None = None
    outside: Node | None = None
    leaf: np.ndarray | None = None


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Euclidean distances by the definition, so equal vectors have equal distances."""
    difference = points - to
    return np.sqrt(np.einsum("...d,...d->...", difference, difference))


def build(points: np.ndarray, members: np.ndarray, leaf: int = LEAF) -> Node:
    """The vantage point is the member farthest from the first; half of the rest is inside."""
    if len(members) <= leaf:
        return Node(leaf=members)
    point = members[np.argmax(distances(points[members], points[members[0]]))]
    rest = members[members != point]
    away = distances(points[rest], points[point])
    radius = float(np.median(away))
    inside = away <= radius
    if inside.all():  # nothing to tell apart: copies of one vector, or equal distances
        return Node(leaf=members)
    return Node(
        int(point),
        radius,
        build(points, rest[inside], leaf),
        build(points, rest[~inside], leaf),
    )


class Search:
    """The nearest ``k`` points of each query in one tree, all queries going down together."""

    def __init__(self, points, ids, queries, query_ids, k: int, factor: float) -> None:
        self.points, self.ids = points, ids
        self.queries, self.query_ids = queries, query_ids
        self.k, self.factor = k, factor
        self.near = np.full((len(queries), k), np.inf)
        self.who = np.full((len(queries), k), -1, dtype=np.int64)

    def offer(self, active: np.ndarray, members: np.ndarray) -> None:
        for start in range(0, len(members), LEAF):
            part = members[start : start + LEAF]
            for at in range(0, len(active), 64):
                some = active[at : at + 64]
                found = distances(self.points[part][None], self.queries[some][:, None])
                found[self.ids[part][None] == self.query_ids[some][:, None]] = np.inf
                self._keep(some, found, np.broadcast_to(self.ids[part], found.shape))

    def _keep(self, active: np.ndarray, found: np.ndarray, ids: np.ndarray) -> None:
        better = (found <= self.near[active, -1:]).any(axis=1)
        if not better.any():
            return
        active, found, ids = active[better], found[better], ids[better]
        distance = np.concatenate([self.near[active], found], axis=1)
        who = np.concatenate([self.who[active], ids], axis=1)
        order = np.lexsort((who, distance), axis=1)[:, : self.k]
        self.near[active] = np.take_along_axis(distance, order, axis=1)
        self.who[active] = np.take_along_axis(who, order, axis=1)

    def run(self, node: Node, active: np.ndarray) -> None:
        if not len(active):
            return
        if node.leaf is not None:
            self.offer(active, node.leaf)
            return
        self.offer(active, np.array([node.point]))
        gap = distances(self.points[node.point], self.queries[active]) - node.radius
        within = gap <= 0
        # The side of the query first: it makes the worst neighbour near, so the other is skipped.
        self.run(node.inside, active[within])
        self.run(node.outside, active[~within])
        reach = np.abs(gap) * self.factor <= self.near[active, -1] + _SLACK
        self.run(node.outside, active[within & reach])
        self.run(node.inside, active[~within & reach])


def _finite(vector):
    value = vector.cast("array<double>")
    return F.coalesce(
        F.exists(value, lambda x: x != 0.0)
        & ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))),
        F.lit(False),
    )


_FOUND = pa.schema([("query_id", pa.int64()), ("member", pa.int64()), ("score", pa.float64())])
_FOUND_SQL = "query_id long, member long, score double"


class Stream:
    """Sorted rows of one or several shards: a shard's vectors come first, then all queries.

    A tree is built once, when its shard's last vector is read; queries pass it in blocks.
    """

    def __init__(self, k: int, factor: float, leaf: int, block: int) -> None:
        self.k, self.factor, self.leaf, self.block = k, factor, leaf, block

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, tree = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            places = np.stack([batch.column(n).to_numpy() for n in ("shard", "size", "kind")])
            cuts = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                if tuple(places[:2, start]) != shard:
                    shard, parts, tree = tuple(places[:2, start]), [], None
                run = _vectors(batch.slice(start, end - start))
                if places[2, start] == 0:
                    parts.append(run)
                    continue
                if tree is None and not parts:
                    continue  # no vector of this length in the shard
                if tree is None:
                    ids, points = map(np.concatenate, zip(*parts))
                    tree, parts = build(points, np.arange(len(ids)), self.leaf), []
                for at in range(0, len(run[0]), self.block):
                    asking = [part[at : at + self.block] for part in run]
                    yield self._search(tree, ids, points, *asking)

    def _search(self, tree, ids, points, query_ids, queries) -> pa.RecordBatch:
        found = Search(points, ids, queries, query_ids, self.k, self.factor)
        found.run(tree, np.arange(len(queries)))
        some = np.isfinite(found.near)
        columns = np.repeat(query_ids, self.k)[some.ravel()], found.who[some], found.near[some]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_FOUND)


def _vectors(run: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, which are of one length."""
    values = run.column("vector").flatten().to_numpy(zero_copy_only=False)
    return run.column("id").to_numpy(), values.reshape(run.num_rows, -1)


def _dealt(points: DataFrame, asked: DataFrame, shards: int) -> DataFrame:
    """Every vector in one shard, every query in all of them; a partition per shard."""

    def placed(rows: DataFrame, shard: Column, kind: int) -> DataFrame:
        place = [F.size("vector").alias("size"), F.lit(kind).alias("kind"), "id", "vector"]
        return rows.select(shard.alias("shard"), *place)

    own = placed(points, F.pmod(F.xxhash64("at"), F.lit(shards)).cast("int"), 0)
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    return own.union(placed(asked, everywhere, 1)).repartitionById(shards, F.col("shard"))


def search(
    queries: DataFrame,
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = NEIGHBOURS,
    factor: float = FACTOR,
) -> DataFrame:
    """``(query_id, rank, key, score)``: the ``k`` nearest of ``vectors`` of each query.

    Rows of the query's own id are no candidates. Nearest first by Euclidean distance in double
    precision, ties to the smaller id; all candidates if there are fewer than ``k``. Vectors that
    are null, zero or hold null or non-finite components take no part, nor do rows without a key.
    Vectors of different lengths never meet. Rows that repeat count as rows; equal rows among the
    queries are one query. Other columns are not read. An empty table has an empty result.

    Vectors lie in shards, spread whatever their values, whose size grows with the root of the rows'
    number until it is bounded by memory. Every shard's vectors and then the queries go through one
    task as a sorted stream, so no vector is copied, a tree is built once, and no task holds more
    than a shard and a block of queries. With ``factor`` 1 the result is exact.
    """

    def used(rows: DataFrame) -> DataFrame:
        values = F.col(vector).cast("array<double>")
        rows = rows.select(F.col(key).cast("long").alias("id"), values.alias("vector"))
        return rows.where(_finite(F.col("vector")) & F.col("id").isNotNull())

    # Tells rows apart that are equal, so that they spread over the shards.
    points = used(vectors).withColumn("at", F.monotonically_increasing_id())
    points = stage(points, "ann-points")
    asked = stage(used(queries).distinct(), "ann-queries")
    counted = points.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("components")).first()
    most = max(1, SHARD_VALUES // max(1, counted.components or 1))
    shards = max(1, int(np.ceil(counted.n / max(1, min(SHARD * counted.n**0.5, most)))))

    together = _dealt(points, asked, shards).sortWithinPartitions("shard", "size", "kind")
    best = together.mapInArrow(Stream(k, factor, LEAF, QUERIES), _FOUND_SQL)
    order = Window.partitionBy("query_id").orderBy("score", "member")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("member").alias(key), "score")
