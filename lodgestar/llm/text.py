"""Words as all operators here understand them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run without ASCII white space; other spaces belong to words.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def split_words(text: str | None) -> list[bytes]:
    """The words in UTF-8; ``bytes.split`` splits at exactly the white space of ``WORD``."""
    return text.encode().split() if text else []


def by_batch(
    handle: Callable[[dict[str, list]], dict[str, list]], schema: pa.Schema, rows: int = 256
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function that hands over at most ``rows`` rows at a time as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = handle(batch.slice(start, rows).to_pydict())
                yield pa.RecordBatch.from_pydict(part, schema=schema)

    return run
