"""Removal of repeated passages of lines by overlapping windows of consecutive lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lodgestar.llm.text import by_batch
from lodgestar.session import stage

LINES = 3


def split_lines(text: str | None) -> list[str]:
    """Lines of a text; none for null and for the empty text."""
    return text.split("\n") if text else []


def window_hashes(lines: list[str]) -> list[tuple[int, bytes]]:
    """Position and 128-bit hash of each window that holds more than spaces."""
    found = []
    for at in range(len(lines) - LINES + 1):
        own = lines[at : at + LINES]
        if any(line.strip(" ") for line in own):
            # Lines hold no line feed, so the joined window is unambiguous.
            found.append((at, xxhash.xxh3_128_digest("\n".join(own).encode())))
    return found


def _windows(docs: DataFrame, key: str, text: str) -> DataFrame:
    names = ("id", "content", "at", "h1", "h2")

    def handle(rows: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in names[:3]}
        digests = []
        for doc, content, body in zip(rows["id"], rows["content"], rows["text"], strict=True):
            found = window_hashes(split_lines(body))
            out["id"] += [doc] * len(found)
            out["content"] += [content] * len(found)
            out["at"] += [at for at, _ in found]
            digests += [digest for _, digest in found]
        halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
        return {**out, "h1": halves[:, 0], "h2": halves[:, 1]}

    narrow = docs.select(
        F.col(key).cast("long").alias("id"),
        F.xxhash64(text).alias("content"),
        F.col(text).alias("text"),
    )
    schema = pa.schema([(name, pa.int64()) for name in names])
    rows = narrow.mapInArrow(
        by_batch(handle, schema), "id long, content long, at long, h1 long, h2 long"
    )
    return rows.select(F.struct("id", "content").alias("own"), "at", "h1", "h2")


def _unused(name: str, taken: list[str]) -> str:
    """``name``, made longer until no column is called so, in any case."""
    known = {column.lower() for column in taken}
    while name in known:
        name += "_"
    return name


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_lines``, ``n_removed`` and ``kept_text``.

    Windows of three consecutive lines are compared everywhere. The first window of each content
    (smallest id, then position) stays; the lines of every later one are removed, overlapping
    windows merged. A window of the same document counts as later only if it does not overlap the
    first, so a run of equal lines keeps three. Windows of white space only are ignored.

    Null and empty texts have no lines and keep an empty text. Rows of equal id and text are the
    same document and keep the same lines; of rows with equal id and different texts the smaller
    text hash comes first. A document of which nothing is left stays as a row with an empty text.
    Columns of other names are handed on, whatever they are called. An empty table has an empty
    result.
    """
    docs = docs.drop("n_lines", "n_removed", "kept_text")
    windows = _windows(docs, key, text)
    first = windows.groupBy("h1", "h2").agg(
        F.min(F.struct("own", "at")).alias("first"), F.count("*").alias("n")
    )
    # Staged: the join can then split a content that fills a partition.
    first = stage(first.where("n > 1").drop("n"), "repeated-lines")
    later = windows.join(first, ["h1", "h2"]).where(
        (F.col("own") > F.col("first.own"))
        | ((F.col("own") == F.col("first.own")) & (F.col("at") >= F.col("first.at") + LINES))
    )
    covered = later.groupBy("own").agg(F.collect_set("at").alias("starts"))
    covered = stage(covered, "covered-lines")
    # The documents as one column, so that none of their names can meet another.
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    own = F.struct(
        F.col("doc").getField(key).cast("long").alias("id"),
        F.xxhash64(F.col("doc").getField(text)).alias("content"),
    )
    # What is covered grows with the corpus: never broadcast, so the plan is the same at every size.
    joined = whole.withColumn("own", own).join(covered.hint("merge"), "own", "left")
    starts = _unused("starts", docs.columns)
    joined = joined.select("doc.*", F.col("starts").alias(starts))

    def handle(rows: dict[str, list]) -> dict[str, list]:
        counts, removed, kept = [], [], []
        for body, windows_ in zip(rows[text], rows.pop(starts), strict=True):
            lines = split_lines(body)
            gone = {start + i for start in windows_ or () for i in range(LINES)}
            counts.append(len(lines))
            removed.append(len(gone))
            kept.append("\n".join(line for at, line in enumerate(lines) if at not in gone))
        return {**rows, "n_lines": counts, "n_removed": removed, "kept_text": kept}

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    schema = to_arrow_schema(docs.schema)
    for name, kind in (("n_lines", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())):
        schema = schema.append(pa.field(name, kind))
    return joined.mapInArrow(
        by_batch(handle, schema), fields + ", n_lines long, n_removed long, kept_text string"
    )
