"""Hard negatives by coordinate pruning: rows of another label that score just below a positive.

The search follows LEMP (Teflioudi et al., 2015): rows lie in buckets of similar length, each bucket
holds a sorted list per coordinate, and what an anchor must reach gives a range of values for its
largest coordinates; only rows in all these ranges are multiplied out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgestar.session import stage

POSITIVES = 5
NEGATIVES = 3
#: Components are multiplied by this and rounded down, so that scores are exact integers.
SCALE = 256
#: A negative scores at least LOW and at most HIGH percent of its positive.
LOW, HIGH = 50, 95
#: Anchors whose results are handed over together.
BLOCK = 256
#: Rows of a bucket, at most; the shortest is at least SIMILAR times as long as the longest.
BUCKET = 1_024
SIMILAR = 0.9
#: Coordinates of an anchor whose ranges are intersected.
FOCUS = 4
#: Rows a shard holds: this times the root of their number, so anchors are sent to few shards ...
SHARD = 16
#: ... but not more components than a task can hold.
SHARD_VALUES = 16_000_000
_SLACK = 1e-6
_EXACT = 2.0**53

def quantised(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of each component x as double; null where the row takes no part.

    That is a null vector, a null or non-finite component, or an integer length of 2^30 or more,
    whose scores would not fit 64 bits.
    """
    scaled = F.transform(vector.cast("array<double>"), lambda x: F.lit(float(scale)) * x)
    bad = F.exists(scaled, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= 2.0**30))
    square = F.aggregate(scaled, F.lit(0.0), lambda total, x: total + F.floor(x) * F.floor(x))
    fine = F.coalesce(~bad, F.lit(False))
    whole = F.transform(scaled, lambda x: F.floor(x).try_cast("int"))
    return F.when(fine & (F.when(fine, square) < 2.0**60), whole)


@dataclass
class Bucket:
    """Rows of similar length, and their coordinates in order."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray  # integers as doubles
    longest: float
    order: np.ndarray  # per coordinate, rows by value
    values: np.ndarray  # per coordinate, those values of the unit rows

    @classmethod
    def of(cls, ids, labels, rows, lengths) -> Bucket:
        unit = (rows / np.where(lengths > 0, lengths, 1.0)[:, None]).T
        order = np.argsort(unit, axis=1, kind="stable").astype(np.int32)
        values = np.take_along_axis(unit, order, axis=1)
        return cls(ids, labels, rows, float(lengths[0]), order, values)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, length: float, least: float):
        """Rows that may score ``least`` with an anchor; all as a slice if that says nothing."""
        reach = length * self.longest
        if least <= 0:
            return slice(None)
        if least > reach * (1 + _SLACK):
            return np.empty(0, np.int64)
        cosine = min(1.0, least / reach)
        # Within the angle of that cosine around the anchor, a coordinate has this range.
        own = unit[focus]
        half = np.sqrt((1 - cosine * cosine) * np.maximum(0.0, 1 - own * own)) + _SLACK
        low = np.where(own <= -cosine + _SLACK, -2.0, own * cosine - half)
        high = np.where(own >= cosine - _SLACK, 2.0, own * cosine + half)
        ranges = []
        for f, a, b in zip(focus, low, high):
            values = self.values[f]
            ranges.append((values.searchsorted(a, "left"), values.searchsorted(b, "right")))
        if min(b - a for a, b in ranges) > 0.8 * len(self.ids):
            return slice(None)
        seen = np.zeros(len(self.ids), np.int8)
        for f, (a, b) in zip(focus, ranges):
            seen[self.order[f, a:b]] += 1
        return np.flatnonzero(seen == len(focus))


def buckets(ids, labels, rows: np.ndarray) -> list[Bucket]:
    """The rows in buckets, longest first."""
    rows = rows.astype(np.float64)
    lengths = np.linalg.norm(rows, axis=1)
    order = np.argsort(-lengths, kind="stable")
    found, start = [], 0
    while start < len(order):
        near = lengths[order[start : start + BUCKET]]
        end = start + max(1, int(np.count_nonzero(near >= SIMILAR * near[0])))
        part = order[start:end]
        found.append(Bucket.of(ids[part], labels[part], rows[part], lengths[part]))
        start = end
    return found


class Best:
    """The ``k`` largest scores so far, ties by smaller id."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]

    def least(self, otherwise: float) -> float:
        """What a further row must reach to be among them."""
        return float(self.scores[-1]) if len(self.scores) == self.k else otherwise


def products(rows: np.ndarray, anchor: np.ndarray, reach: float) -> np.ndarray:
    """Exact inner products of integer rows with an integer anchor."""
    if reach < _EXACT:  # no sum on the way is larger, so doubles are exact
        return (rows @ anchor).astype(np.int64)
    return rows.astype(np.int64) @ anchor.astype(np.int64)


class Anchor:
    def __init__(self, own_id: int, label: int, row: np.ndarray) -> None:
        self.id, self.label = own_id, label
        self.row = row.astype(np.float64)
        self.length = float(np.linalg.norm(self.row))
        self.unit = self.row / self.length if self.length else self.row
        self.focus = np.argsort(-np.abs(self.unit), kind="stable")[:FOCUS]

    def scored(self, bucket: Bucket, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the bucket's rows of the same or another label that reach ``least``."""
        some = bucket.candidates(self.unit, self.focus, self.length, least)
        if not isinstance(some, slice) and not len(some):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        scores = products(bucket.rows[some], self.row, self.length * bucket.longest * 1.001)
        ids = bucket.ids[some]
        wanted = ((bucket.labels[some] == self.label) == same) & (ids != self.id)
        if least > -np.inf:
            wanted &= scores >= least
        return scores[wanted], ids[wanted]


def best_positives(anchor: Anchor, shard: list[Bucket], k: int) -> Best:
    best = Best(k)
    for bucket in shard:
        best.offer(*anchor.scored(bucket, best.least(-np.inf), same=True))
    return best


def best_negatives(
    anchor: Anchor, positive_scores: np.ndarray, shard: list[Bucket], k: int, low: int, high: int
) -> list[Best]:
    """For each positive score, the ``k`` best rows of another label in its band."""
    best = [Best(k) for _ in positive_scores]
    bands = [(-(-low * int(s) // 100), high * int(s) // 100) for s in positive_scores]
    open_ = [n for n, (a, b) in enumerate(bands) if a <= b]
    for bucket in shard if open_ else ():
        least = min(best[n].least(bands[n][0]) for n in open_)
        scores, ids = anchor.scored(bucket, least, same=False)
        for n in open_ if len(scores) else ():
            inside = (scores >= bands[n][0]) & (scores <= bands[n][1])
            best[n].offer(scores[inside], ids[inside])
    return best


_FOUND = pa.schema(
    [
        ("anchor_id", pa.int64()),
        ("anchor", pa.int64()),
        ("place", pa.int32()),
        ("positive_id", pa.int64()),
        ("positive_score", pa.int64()),
        ("member", pa.int64()),
        ("score", pa.int64()),
    ]
)
_FOUND_SQL = (
    "anchor_id long, anchor long, place int, positive_id long, positive_score long, member long,"
    " score long"
)


class Stream:
    """Sorted rows of one or several shards: a shard's rows come first, then all anchors."""

    def __init__(self, k: int, low: int, high: int, negatives: bool) -> None:
        self.k, self.low, self.high, self.negatives = k, low, high, negatives

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, parts, index = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            places = np.stack([batch.column(n).to_numpy() for n in ("shard", "kind")])
            cuts = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1
            for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                run = batch.slice(start, end - start)
                if places[0, start] != shard:
                    shard, parts, index = places[0, start], [], None
                if places[1, start] == 0:
                    parts.append(_matrices(run))
                    continue
                if index is None:
                    index, parts = _index(parts), []
                for at in range(0, run.num_rows, BLOCK):
                    yield self._search(run.slice(at, BLOCK), index)

    def _search(self, run: pa.RecordBatch, index: dict[int, list[Bucket]]) -> pa.RecordBatch:
        ids, labels, keys = (run.column(n).to_pylist() for n in ("id", "label", "anchor"))
        found = []
        for n, (own, label, key) in enumerate(zip(ids, labels, keys)):
            row = _values(run.column("q").slice(n, 1))
            shard = index.get(len(row), [])
            anchor = Anchor(own, label, row)
            if not self.negatives:
                best = best_positives(anchor, shard, self.k)
                found += [(own, key, 0, None, None, *f) for f in zip(best.ids, best.scores)]
                continue
            positives = run.column("positives")[n].as_py()
            scores = [p["score"] for p in positives]
            each = best_negatives(anchor, scores, shard, self.k, self.low, self.high)
            for place, (positive, best) in enumerate(zip(positives, each)):
                about = (own, key, place, positive["id"], positive["score"])
                found += [(*about, *f) for f in zip(best.ids, best.scores)]
        columns = zip(*found) if found else [[]] * len(_FOUND)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND
        )


def _values(lists: pa.ListArray) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def _matrices(run: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, labels and rows of each vector length in the run."""
    vectors = run.column("q")
    ids, labels = run.column("id").to_numpy(), run.column("label").to_numpy()
    lengths = vectors.value_lengths().to_numpy()
    parts = []
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        part = vectors if len(at) == len(lengths) else vectors.take(pa.array(at))
        parts.append((ids[at], labels[at], _values(part).reshape(len(at), length)))
    return parts


def _index(runs: list) -> dict[int, list[Bucket]]:
    by_length = {}
    for part in (part for run in runs for part in run):
        by_length.setdefault(part[2].shape[1], []).append(part)
    return {n: buckets(*map(np.concatenate, zip(*parts))) for n, parts in by_length.items()}


def _searched(rows: DataFrame, anchors: DataFrame, shards: int, stream: Stream) -> DataFrame:
    """What ``stream`` finds for each anchor in each shard of ``rows``."""
    places = "shard int, kind int, id long, label long, q array<int>, anchor long"
    kept = f"{places}, positives array<struct<id: long, score: long>>"
    names = [part.split()[0] for part in places.split(", ")]
    own = rows.select(
        F.pmod(F.xxhash64("at"), F.lit(shards)).cast("int").alias("shard"),
        F.lit(0).alias("kind"),
        "id",
        "label",
        "q",
        F.lit(None).cast("long").alias("anchor"),
        F.lit(None).cast("array<struct<id: long, score: long>>").alias("positives"),
    )
    everywhere = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    asking = everywhere.withColumn("kind", F.lit(1)).select(*names, "positives")
    together = own.union(asking).repartitionById(shards, F.col("shard"))
    return together.sortWithinPartitions("shard", "kind").mapInArrow(stream, _FOUND_SQL)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Rows for which the column ``anchors`` holds are the anchors. Scores are inner products of the
    vectors as ``quantised``; higher ones come first, ties by smaller key. An anchor's positives
    are its first ``positives`` other rows of its label, the negatives of each its first
    ``negatives`` rows of another label between ``low`` and ``high`` percent of the positive's
    score; fewer where there are fewer, so a positive with a negative score has none.

    Rows with a null key, label or vector or a component that is null or not finite take no part,
    nor do vectors whose scores would not fit 64 bits. Vectors of another length meet only those of
    their own length. A row never meets rows of its own key. Rows that repeat count as rows among
    positives and negatives; an anchor that repeats in key, label and vector is one anchor. Other
    columns are not read. An empty table has an empty result.

    Rows lie in shards, whose number grows with the root of the rows' until a shard's size is
    bounded by memory; every shard's rows and then the anchors go through one task as a sorted
    stream, so no task holds more than a shard and a block of anchors.
    """
    used = rows.select(
        F.col(key).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        quantised(F.col(vector)).alias("q"),
        F.coalesce(anchors, F.lit(False)).alias("asks"),
        # Tells rows apart that are equal, so that they spread over the shards.
        F.monotonically_increasing_id().alias("at"),
    )
    used = stage(used.where("id IS NOT NULL AND label IS NOT NULL AND q IS NOT NULL"), "lemp-rows")
    counted = used.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("components")).first()
    most = max(1, SHARD_VALUES // max(1, counted.components or 1))
    shards = max(1, int(np.ceil(counted.n / max(1, min(SHARD * counted.n**0.5, most)))))
    empty = F.lit(None).cast("array<struct<id: long, score: long>>").alias("positives")
    asking = used.where("asks").select("id", "label", "q").distinct()
    asking = stage(asking.withColumn("anchor", F.xxhash64("label", "q")), "lemp-anchors")

    near = _searched(
        used, asking.select("*", empty), shards, Stream(positives, low, high, negatives=False)
    )
    order = [F.desc("score"), F.asc("member")]
    place = F.row_number().over(Window.partitionBy("anchor_id", "anchor").orderBy(*order))
    best = near.withColumn("place", place).where(F.col("place") <= positives)
    # At most a handful of rows per anchor.
    listed = F.sort_array(F.collect_list(F.struct("place", "member", "score")))
    pairs = F.transform(listed, lambda p: F.struct(p["member"].alias("id"), p["score"].alias("score")))
    found = best.groupBy(F.col("anchor_id").alias("id"), "anchor").agg(pairs.alias("positives"))
    told = stage(asking.join(found, ["id", "anchor"]), "lemp-positives")

    hard = _searched(used, told, shards, Stream(negatives, low, high, negatives=True))
    group = Window.partitionBy("anchor_id", "anchor", "place").orderBy(*order)
    ranked = hard.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= negatives)
    return ranked.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("member").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
