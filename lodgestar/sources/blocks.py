"""Text files read in splits of any size, with what a task needs to know about its place in a file.

Spark hands a file to tasks in blocks of bytes, and a task sees the rows of a block in their order.
The helpers here look at that order in Arrow batches, so that no text has to be shuffled to tell the
first row of a file or to put lines together that belong to one record.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters that a record may reach into the next block.
OVERHANG = 1 << 20


def read_blocks(spark: SparkSession, paths: str | list[str], separator: str) -> DataFrame:
    """Pieces of text between separators: value, path, file (a hash of it), block (its first byte)."""
    return spark.read.text(paths, lineSep=separator).select(
        "value",
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_path").alias("path"),
    )


def block_runs(
    batches: Iterable[pa.RecordBatch],
) -> Iterator[tuple[tuple[int, int], bool, pa.RecordBatch]]:
    """``((file, block), whether the block starts here, its rows)`` in the order of the text."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        places = np.stack([batch.column("file").to_numpy(), batch.column("block").to_numpy()])
        cuts = np.flatnonzero((places[:, 1:] != places[:, :-1]).any(axis=0)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            place = (int(places[0, start]), int(places[1, start]))
            yield place, place != last, batch.slice(start, end - start)
            last = place


def with_heads(pieces: DataFrame, *, placed: bool = False) -> DataFrame:
    """``(value, head)``: ``head`` marks the first piece of each file.

    ``placed`` adds the place of each piece: file (its path), block, row.
    """
    place = ("path", "block") if placed else ()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for (_, block), first, run in block_runs(batches):
            head = np.zeros(run.num_rows, dtype=bool)
            head[0] = first and block == 0
            at = 0 if first else at
            columns = {"value": run.column("value"), "head": pa.array(head)}
            if placed:
                columns["file"], columns["block"] = (run.column(name) for name in place)
                columns["row"] = pa.array(np.arange(at, at + run.num_rows))
            at += run.num_rows
            yield pa.RecordBatch.from_pydict(columns)

    fields = "value string, head boolean" + ", file string, block long, row long" * placed
    return pieces.select("value", "file", "block", *place[:1]).mapInArrow(mark, fields)


_PROFILE = pa.schema(
    [
        ("file", pa.int64()),
        ("block", pa.int64()),
        ("odd", pa.bool_()),
        ("start", pa.string()),
        ("crlf", pa.bool_()),
    ]
)


def _odd(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2 == 1


class _Profile:
    """A block's parity of quotes, and its text up to the first line with an odd number of them."""

    def __init__(self, place: tuple[int, int], crlf: bool) -> None:
        self.place, self.crlf = place, crlf
        self.odd, self.lines, self.length, self.closed = False, [], 0, False

    def add(self, lines: pa.Array) -> None:
        odd = _odd(lines)
        self.odd ^= bool(np.count_nonzero(odd) % 2)
        if self.closed or self.length > OVERHANG:
            return
        at = np.flatnonzero(odd)
        self.closed = len(at) > 0
        for line in lines.slice(0, at[0] + 1 if self.closed else len(lines)):
            self.lines.append(line.as_py())
            self.length += len(self.lines[-1]) + 1
            if self.length > OVERHANG:
                self.lines, self.closed = [], False
                return

    def row(self) -> pa.RecordBatch:
        start = "\n".join(self.lines) if self.closed else None
        columns = [[self.place[0]], [self.place[1]], [self.odd], [start], [self.crlf]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _PROFILE)], schema=_PROFILE
        )


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    profile = None
    for place, first, run in block_runs(batches):
        if first:
            if profile is not None:
                yield profile.row()
            profile = _Profile(place, run.column("value")[0].as_py().endswith("\r"))
        profile.add(run.column("value"))
    if profile is not None:
        yield profile.row()


def _block_states(lines: DataFrame) -> DataFrame:
    """Per block: whether a quote is open before it, and the text that ends its last record."""
    profiles = lines.select("value", "file", "block").mapInArrow(
        _profiles, "file long, block long, odd boolean, start string, crlf boolean"
    )
    order = Window.partitionBy("file").orderBy("block")
    quotes = F.sum(F.col("odd").cast("int"))
    before = F.coalesce(quotes.over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = quotes.over(order.rowsBetween(Window.unboundedPreceding, 0))
    follows = F.lead(F.lit(True)).over(order)
    too_long = F.raise_error(
        F.lit("a quoted field reaches far into the next block, read this input with mode='whole'")
    )
    rest = F.lead(F.coalesce("start", F.lit(""))).over(order)
    missing = F.lead(F.col("start").isNull()).over(order)
    return profiles.select(
        "file",
        "block",
        (before % 2 == 1).alias("open"),
        F.when((after % 2 == 1) & follows, F.when(missing, too_long).otherwise(rest)).alias("rest"),
        F.first("crlf").over(order).alias("crlf"),
    )


_RECORDS = pa.schema(
    [("value", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("row", pa.int64())]
)


def _joined(lines: list[str], crlf: bool) -> str:
    text = "\n".join(lines)
    return text.replace("\r\n", "\n").removesuffix("\r") if crlf else text


class _Records:
    """Puts the lines of one block together; ``pending`` are those of a record not yet closed."""

    def __init__(self, place: tuple[int, int], run: pa.RecordBatch) -> None:
        self.block, self.at = place[1], 0
        self.path = run.column("path")[0].as_py() if "path" in run.schema.names else None
        self.open = run.column("open")[0].as_py()
        self.rest, self.crlf = run.column("rest")[0].as_py(), run.column("crlf")[0].as_py()
        # What ends a record of the block before is in that block's ``rest``.
        self.skip = self.open
        self.pending: list[str] = []
        self.began = 0

    def _batch(self, values, lines) -> pa.RecordBatch:
        size = len(lines)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(values, pa.string()) if isinstance(values, list) else values,
                pa.array([self.path] * size, pa.string()),
                pa.array(np.full(size, self.block)),
                pa.array(lines, pa.int64()),
            ],
            schema=_RECORDS,
        )

    def add(self, lines: pa.Array) -> Iterator[pa.RecordBatch]:
        inside_after = np.logical_xor(np.cumsum(_odd(lines)) % 2 == 1, self.open)
        inside_before = np.concatenate([[self.open], inside_after[:-1]])
        alone = ~inside_before & ~inside_after
        if alone.any():
            values = lines.filter(pa.array(alone))
            if self.crlf:
                values = pc.replace_substring_regex(values, r"\r$", "")
            yield self._batch(values, self.at + np.flatnonzero(alone))
        texts, starts = [], []
        for n in np.flatnonzero(~alone):
            if not inside_before[n]:
                self.pending, self.began = [], self.at + int(n)
            if not self.skip:
                self.pending.append(lines[int(n)].as_py())
            if not inside_after[n]:
                if not self.skip:
                    texts.append(_joined(self.pending, self.crlf))
                    starts.append(self.began)
                self.pending, self.skip = [], False
        if texts:
            yield self._batch(texts, starts)
        self.open = bool(inside_after[-1])
        self.at += len(lines)

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.pending:
            lines = [*self.pending, *([] if self.rest is None else [self.rest])]
            yield self._batch([_joined(lines, self.crlf)], [self.began])


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    records = None
    for place, first, run in block_runs(batches):
        if first:
            if records is not None:
                yield from records.end()
            records = _Records(place, run)
        yield from records.add(run.column("value"))
    if records is not None:
        yield from records.end()


def read_quoted_records(
    spark: SparkSession, paths: str | list[str], *, placed: bool = False
) -> DataFrame:
    """Records of CSV files whose quoted fields may hold newlines: value, file, block, row.

    A line belongs to a record that an earlier line began if the quotes before it are odd in
    number. A first scan counts the quotes of each block and keeps the text up to the first line
    with an odd number; prefix sums over the blocks of a file give the state at every block's start
    and the end of a record that reaches into the next block. A second scan puts the records
    together. No text is shuffled, and a file of any size is read by many tasks. ``row`` counts
    lines from the start of the block in which the record starts; ``file`` is null unless ``placed``.

    The table of blocks has one row per split, of which the driver holds a list as well when it
    plans the scan, and at most one piece of text per split; it is broadcast. Where a record reaches
    more than ``OVERHANG`` characters into the next block, or to the one after it, the job fails.
    """
    lines = read_blocks(spark, paths, "\n")
    states = _block_states(lines).withColumn("known", F.lit(True))
    known = lines.join(F.broadcast(states), ["file", "block"], "left")
    changed = F.raise_error(F.lit("a file was split differently in two scans"))
    opened = F.when(F.col("known"), F.col("open")).otherwise(changed)
    needed = ["value", "file", "block", "rest", "crlf", *(["path"] if placed else [])]
    return known.select(*needed, opened.cast("boolean").alias("open")).mapInArrow(
        _records, "value string, file string, block long, row long"
    )
