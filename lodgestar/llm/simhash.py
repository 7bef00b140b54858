"""SimHash near-duplicates by covering locality-sensitive hashing.

Two fingerprints of at most ``RADIUS`` differing bits agree on all bits of at least one mask. The
masks follow Pagh (2016): every bit position carries a nonzero vector of ``RADIUS + 1`` bits, and the
mask of a vector v holds the positions whose vectors have an odd inner product with v. The vectors of
up to ``RADIUS`` differing positions never span the whole space, so some v is orthogonal to all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgestar.llm.graph import connected_components
from lodgestar.llm.text import by_batch, split_words
from lodgestar.session import stage

SHINGLE = 4
RADIUS = 4
#: Buckets with more fingerprints are cut by a second set of masks.
LARGE_BUCKET = 2_000


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = 42) -> int:
    """Unsigned 64-bit fingerprint: a bit is set if over half of the shingle hashes set it."""
    words = split_words(text and text)
    words = [w.lower() for w in words]  # bytes.lower changes A-Z only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    first = [0, *(ends[:-1] + 1).tolist()]
    last = ends[shingle - 1 :].tolist() or [len(joined)]
    view = memoryview(joined)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(view[a:b], seed) for a, b in zip(first, last)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        block = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, fp)``: the fingerprint of each row's whole text as a signed 64-bit integer."""

    def handle(rows: dict[str, list]) -> dict[str, list]:
        found = np.array([fingerprint(t) for t in rows["text"]], dtype=np.uint64)
        return {"id": rows["id"], "fp": found.view(np.int64).tolist()}

    narrow = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])
    rows = narrow.mapInArrow(by_batch(handle, schema), "id long, fp long")
    return rows.withColumnRenamed("id", key)


def covering_masks(positions: Sequence[int], radius: int = RADIUS) -> list[int]:
    """Masks over ``positions`` of which one avoids any ``radius`` of them."""
    size = radius + 1
    carried = {bit: 1 + n % ((1 << size) - 1) for n, bit in enumerate(positions)}
    return [
        sum(1 << bit for bit, vector in carried.items() if (vector & v).bit_count() % 2)
        for v in range(1, 1 << size)
    ]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _linked(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning set of links of the points within ``radius``, by search from point to point.

    A found point leaves the set that is still searched, so a large group costs little more than
    one comparison per point, and no list of pairs arises.
    """
    left = np.unique(points)
    ends: list[np.ndarray] = []
    roots: list[np.ndarray] = []
    while len(left):
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                ends.append(found)
                roots.append(np.full(len(found), root))
                queue.extend(found)
    if not ends:
        return points[:0], points[:0]
    return np.concatenate(ends), np.concatenate(roots)


def _bucket_links(buckets: DataFrame, by: list[str], radius: int) -> DataFrame:
    """Links within each bucket. A bucket is one row, as its size is bounded."""

    def search(rows: dict[str, list]) -> dict[str, list]:
        found = [_linked(np.array(fps, np.int64).view(np.uint64), radius) for fps in rows["fps"]]
        return {
            "a": np.concatenate([a for a, _ in found]).view(np.int64),
            "b": np.concatenate([b for _, b in found]).view(np.int64),
        }

    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    lists = buckets.groupBy(*by).agg(F.collect_list("fp").alias("fps")).select("fps")
    return lists.mapInArrow(by_batch(search, schema), "a long, b long")


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` that connect exactly what pairs within ``radius`` bits connect.

    ``distinct`` holds each fingerprint ``fp`` once. A bucket is the fingerprints that agree on a
    mask. In a bucket of more than ``LARGE_BUCKET``, pairs still differ in at most ``radius`` of the
    other bits, so a second covering over these bits cuts it without a loss; 16 bits at most are
    then free, so no group can exceed 65,536 fingerprints.
    """
    masks = covering_masks(range(64), radius)
    tables = distinct.select(
        "fp",
        F.posexplode(
            F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")) for m in masks])
        ).alias("mask", "bucket"),
    )
    sizes = tables.groupBy("mask", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = tables.join(stage(sizes, "simhash-buckets"), ["mask", "bucket"])
    members = stage(members, "simhash-members")
    small = members.where(F.col("n") <= LARGE_BUCKET)
    links = _bucket_links(small, ["mask", "bucket"], radius)
    second = [
        [_signed(m) for m in covering_masks([b for b in range(64) if not mask >> b & 1], radius)]
        for mask in masks
    ]
    chosen = F.get(F.lit(second).cast("array<array<bigint>>"), F.col("mask"))
    large = members.where(F.col("n") > LARGE_BUCKET).select(
        "fp",
        "mask",
        "bucket",
        F.posexplode(F.transform(chosen, lambda m: F.col("fp").bitwiseAND(m))).alias(
            "mask2", "bucket2"
        ),
    )
    return links.union(_bucket_links(large, ["mask", "bucket", "mask2", "bucket2"], radius))


def simhash_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """``(key, fingerprint, component_id)`` for every row of ``docs``.

    Documents link if their fingerprints differ in at most ``radius`` bits; ``component_id`` is the
    smallest id reachable. Equal fingerprints are one class from the start, so any number of copies
    is one row in the search. Texts without words have fingerprint zero and link like any other.
    Rows with a null id belong to components but never name one, unless no member has an id.
    """
    rows = stage(fingerprints(docs, key, text), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min(key).alias("smallest"))
    classes = stage(classes, "fingerprint-classes")
    found = connected_components(fingerprint_links(classes.select("fp"), radius))
    # Components are named by fingerprints first, then by their smallest document.
    joined = classes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "smallest", F.coalesce("component", "fp").alias("component")
    )
    named = joined.groupBy("component").agg(F.min("smallest").alias("component_id"))
    named = stage(
        joined.join(named, "component").select("fp", "component_id"), "simhash-components"
    )
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(named, "fp").select(key, digits.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without near-duplicates: of each component the row with the smallest id.

    Of several rows with that id, one with the smallest text stays; rows without an id whose
    component has none are all kept, as nothing tells them apart.
    """
    found = simhash_components(docs, key, text)
    stay = found.where(F.col(key) == F.col("component_id")).select(key).distinct()
    nameless = docs.where(F.col(key).isNull())
    kept = docs.join(stage(stay, "simhash-kept"), key, "left_semi")
    once = kept.groupBy(key).agg(F.min(F.struct(text, *[c for c in docs.columns if c not in (key, text)])).alias("row"))
    return once.select(key, "row.*").select(*docs.columns).union(nameless)
