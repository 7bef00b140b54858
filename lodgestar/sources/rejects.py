"""Rows with values that cannot be read, told by reason and place within the scan that reads them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgestar.schemas import REJECT_COLUMNS

#: Type of the column ``reject``; null where a row has no fault. ``block`` is the first byte of the
#: part of the file that a task read, ``row`` grows in the order of the text within it, and ``kept``
#: tells whether the row still counts, without the bad value.
REJECT = "struct<" + ", ".join(f"{name}: {kind}" for name, kind in REJECT_COLUMNS) + ">"


def reason(name: str, raw: Column, typed: Column, *, required: bool = True) -> Column:
    """What is wrong with a field, or null."""
    missing = F.when(raw.isNull(), F.lit(f"{name} missing")) if required else F.lit(None)
    malformed = F.when(raw.isNotNull() & typed.isNull(), F.lit(f"{name} malformed"))
    return F.coalesce(missing, malformed)


def reject(source: str, reasons: Sequence[Column], raw: Column, kept: Column) -> Column:
    """The ``reject`` column of rows with ``file``, ``block`` and ``row``."""
    found = F.array_compact(F.array(*reasons))
    told = F.struct(
        F.lit(source).alias("source"),
        F.col("file"),
        F.col("block"),
        F.col("row"),
        found.alias("reasons"),
        raw.alias("raw"),
        kept.alias("kept"),
    )
    return F.when(F.size(found) > 0, told.cast(REJECT)).alias("reject")


def both_ways(rows: DataFrame, *keep: str) -> DataFrame:
    """Rows that count, without ``reject``, and the rejected ones with it; some rows are both.

    The latter have nothing else but ``keep``: what is wrong with a row tells all there is of it.
    """
    fault = F.col("reject").isNotNull()
    counts = F.array(F.lit(False))
    ways = F.when(~fault, counts).otherwise(
        F.when(F.col("reject.kept"), F.array(F.lit(False), F.lit(True))).otherwise(
            F.array(F.lit(True))
        )
    )
    dealt = rows.withColumn("rejected_", F.explode(ways))
    rejected = F.col("rejected_")
    others = [name for name in rows.columns if name not in ("reject", *keep)]
    return dealt.select(
        *keep,
        *[F.when(~rejected, F.col(name)).alias(name) for name in others],
        F.when(rejected, F.col("reject")).alias("reject"),
    )
