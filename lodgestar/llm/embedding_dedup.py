"""Near-duplicate vectors by tiled comparison in the order of principal components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgestar.llm.graph import connected_components
from lodgestar.session import stage

THRESHOLD = 0.95
TILE = 4_096
#: Leading components that are accumulated before the bound is tried, then again.
STEPS = (8, 16, 24, 40)
_ROWS = 512  # of a tile that are compared at once
_SLACK = 1e-9  # more than rounding can change a product of unit vectors


def usable(vector: Column) -> Column:
    """Not null, not zero, and all components finite."""
    value = vector.cast("array<double>")
    bad = F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(
        vector.isNotNull() & ~bad & F.exists(value, lambda x: x != 0.0), F.lit(False)
    )


def as_matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by the largest component first, so nothing over- or underflows."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def principal_axes(vectors: DataFrame) -> np.ndarray:
    """Orthonormal axes of unit ``vectors``, largest spread first.

    The second moments of all rows are summed within each task. Only these sums, whose size depends
    on the dimension alone, are added up and read by the driver.
    """

    def moments(batches):
        total = None
        for rows in batches:
            if len(rows):
                part = unit(as_matrix(rows["vector"]))
                part = part.T @ part
                total = part if total is None else total + part
        if total is not None:
            at = np.arange(total.size)
            yield pd.DataFrame({"at": at, "value": total.ravel()})

    sums = vectors.select("vector").mapInPandas(moments, "at long, value double")
    rows = sums.groupBy("at").agg(F.sum("value").alias("value")).toPandas()
    if rows.empty:
        return np.zeros((0, 0))
    size = int(round(len(rows) ** 0.5))
    matrix = rows.sort_values("at")["value"].to_numpy().reshape(size, size)
    return np.linalg.eigh(matrix)[1][:, ::-1].copy()


def close_pairs(
    left: np.ndarray, right: np.ndarray, threshold: float, steps: tuple[int, ...] = STEPS
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit rows, in principal order, whose product reaches ``threshold``.

    After each step the product so far plus the product of the norms of what is left bounds the
    cosine; pairs below the threshold stop there.
    """
    rows, columns, size = [], [], left.shape[1]
    steps = tuple(s for s in steps if s < size)
    first = steps[0] if steps else size

    def rest(part: np.ndarray, at: int) -> np.ndarray:
        return np.linalg.norm(part[:, at:], axis=1)

    bounds = {at: (rest(left, at), rest(right, at)) for at in (*steps, size)}
    for start in range(0, len(left), _ROWS):
        block = slice(start, start + _ROWS)
        a, b = bounds[first]
        reach = left[block, :first] @ right[:, :first].T
        i, j = np.nonzero(reach + np.outer(a[block], b) >= threshold - _SLACK)
        product = reach[i, j]
        i = i + start
        for at, to in zip((first, *steps[1:]), (*steps[1:], size)):
            if at == size or not len(i):
                break
            product = product + np.einsum("nd,nd->n", left[i, at:to], right[j, at:to])
            a, b = bounds[to]
            open_ = product + a[i] * b[j] >= threshold - _SLACK
            i, j, product = i[open_], j[open_], product[open_]
        rows.append(i)
        columns.append(j)
    return np.concatenate(rows), np.concatenate(columns)


def _tiled(classes: DataFrame, axes: np.ndarray, threshold: float) -> DataFrame:
    """``classes`` once per pair of tiles that may hold links: ``(l, r)`` and the row's own tile.

    A cell is a square of the two leading components with the side of the largest distance of
    linked vectors, so links stay within a cell or go to the next. A cell of more than ``TILE``
    rows is cut by hash. At most 49 cells exist, whatever the number of rows.
    """
    side = float(np.sqrt(2 * (1 - threshold))) + 1e-6 if threshold < 1 else 1e-3
    lead = axes[:, :2]

    def cells(batches):
        for rows in batches:
            if len(rows):
                at = np.floor(unit(as_matrix(rows["vector"])) @ lead / side).astype(np.int32)
                y = at[:, 1] if at.shape[1] > 1 else np.zeros(len(at), np.int32)
                yield rows.assign(x=at[:, 0], y=y)

    schema = classes.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    placed = stage(classes.mapInPandas(cells, fields + ", x int, y int"), "vector-cells")
    sizes = placed.groupBy("x", "y").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    sizes = stage(sizes, "vector-cell-sizes")
    near = sizes.selectExpr("x", "y", "tiles", "explode(sequence(x - 1, x + 1)) AS nx").selectExpr(
        "x", "y", "tiles", "nx", "explode(sequence(y - 1, y + 1)) AS ny"
    )
    other = sizes.selectExpr("x AS nx", "y AS ny", "tiles AS ntiles")
    near = near.join(other, ["nx", "ny"])
    near = near.groupBy("x", "y", "tiles").agg(
        F.collect_list(F.struct("nx", "ny", "ntiles")).alias("near")
    )
    # One row per cell.
    rows = placed.join(F.broadcast(stage(near, "vector-cell-pairs")), ["x", "y"])

    def tile(x: Column, y: Column, t: Column) -> Column:
        cell = (x.cast("long") + 64) * 256 + y + 64
        return cell * (1 << 32) + t

    own = tile(F.col("x"), F.col("y"), F.pmod(F.xxhash64("member"), F.col("tiles")))
    others = F.flatten(
        F.transform(
            "near",
            lambda c: F.transform(
                F.sequence(F.lit(0), c["ntiles"] - 1),
                lambda t: tile(c["nx"], c["ny"], t),
            ),
        )
    )
    rows = rows.withColumn("own", own).withColumn("other", F.explode(others))
    return rows.select(
        *[f.name for f in schema],
        "own",
        F.least("own", "other").alias("l"),
        F.greatest("own", "other").alias("r"),
    )


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` per row: links are pairs of cosine >= ``threshold``.

    Vectors that are null, zero or hold null or non-finite components link with nothing. Equal
    vectors are one class from the start; a class with itself counts as links. A tile pair returns
    counts and a spanning set of its links, at most two rows per vector, never pairs. Vectors of
    another length than most (of equally frequent lengths, the smaller) link with equal ones only.
    Rows of equal key count as rows, and share their component. Other columns are not read. An
    empty table has an empty result.
    """
    rows = vectors.select(F.col(key).cast("long").alias("member"), F.col(vector).alias("vector"))
    good = rows.where(usable(F.col("vector")))
    classes = good.groupBy("vector").agg(
        F.min("member").alias("member"), F.count("*").alias("copies")
    )
    classes = stage(classes.select("member", "vector", "copies"), "vector-classes")
    lengths = classes.groupBy(F.size("vector").alias("size")).agg(F.sum("copies").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "size").first()
    alike = classes.where(F.size("vector") == (usual.size if usual else 0))
    axes = principal_axes(alike)
    none = "member long, n long, root long"
    if axes.size == 0:
        found = vectors.sparkSession.createDataFrame([], none)
    else:

        def compare(group: pd.DataFrame) -> pd.DataFrame:
            is_left = (group["own"] == group["l"]).to_numpy()
            same = bool(group["l"].iloc[0] == group["r"].iloc[0])
            left = group[is_left]
            right = left if same else group[~is_left]
            if not len(left) or not len(right):
                return pd.DataFrame({"member": [], "n": [], "root": []})
            a = unit(as_matrix(left["vector"]))
            b = a if same else unit(as_matrix(right["vector"]))
            i, j = close_pairs(a @ axes, b @ axes, threshold)
            # The rotation rounds; the decision is by the vectors as given.
            exact = np.einsum("nd,nd->n", a[i], b[j]) >= threshold
            if same:
                exact &= i != j
            i, j = i[exact], j[exact]
            ids_a, ids_b = left["member"].to_numpy(), right["member"].to_numpy()
            copies_a, copies_b = left["copies"].to_numpy(), right["copies"].to_numpy()
            out = [_counts(ids_a, i, copies_b[j])]
            if not same:
                out.append(_counts(ids_b, j, copies_a[i]))
            out.append(_spanning(ids_a[i], ids_b[j]))
            return pd.concat(out, ignore_index=True)

        tiles = _tiled(alike, axes, threshold)
        found = stage(tiles.groupBy("l", "r").applyInPandas(compare, none), "vector-links")
    counts = found.where("n > 0").groupBy("member").agg(F.sum("n").alias("n"))
    components = connected_components(found.where("n = 0").selectExpr("member AS a", "root AS b"))
    summed = (
        classes.join(counts, "member", "left")
        .join(components.withColumnRenamed("node", "member"), "member", "left")
        .select(
            "vector",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "member").alias("component_id"),
        )
    )
    linked = stage(summed.where("n_links > 0"), "vector-components")
    # A null vector equals none.
    joined = rows.join(linked, "vector", "left")
    component = F.coalesce("component_id", "member")
    return joined.select(
        F.col("member").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("member") == component, F.lit(False)).alias("kept"),
    )


def _counts(ids: np.ndarray, at: np.ndarray, weights: np.ndarray) -> pd.DataFrame:
    totals = np.bincount(at, weights=weights, minlength=len(ids)).astype(np.int64)
    some = totals > 0
    return pd.DataFrame({"member": ids[some], "n": totals[some], "root": ids[some]})


def _spanning(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    """Each end of the pairs with the smallest id it is connected to among them."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
        if np.array_equal(root, before):
            break
    return pd.DataFrame({"member": nodes, "n": 0, "root": nodes[root]}).astype("int64")
