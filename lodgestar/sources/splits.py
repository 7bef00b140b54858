"""Spreading inputs that few tasks read."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(rows: DataFrame, partitions: int | None, *keys: str) -> DataFrame:
    """``rows`` moved by key to ``partitions`` tasks before costly work per row.

    For unsplittable files (whole texts, one large row group). The plan depends on ``partitions``
    alone, never on the machine or the input; None leaves the rows where they were read.
    """
    return rows if partitions is None else rows.repartition(partitions, *keys)
