"""CSV reading shared by listings and calendars."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgestar.sources.blocks import read_quoted_records

OPTIONS = {"quote": '"', "escape": '"'}

# No column of a file is called so.
PLACE = "lodgestar place"

# Fields without quotes, or in quotes with each inner quote doubled. Never tried a second way.
_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
_WELL_FORMED = rf"\A{_FIELD}(?:,{_FIELD})*+\z"


def read_named_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: Iterable[str],
    *,
    mode: str = "lines",
    placed: bool = False,
) -> DataFrame:
    """Read string columns by header name (any case and order, further columns are ignored).

    Only the header line is looked at before the job runs. A quoted field may hold commas and
    doubled quotes. ``mode`` tells what else it may hold and how files are dealt to tasks:

    ``lines``: no newlines; every line is a row, files of any size are split.
    ``split``: newlines too, and files are split all the same, see ``read_quoted_records``. A quote
    within a field that does not start with one fails the job, as it would shift what is quoted.
    ``whole``: anything Spark's multi-line reader takes, one task per file.

    ``placed`` adds the place of each row: file, block and row, see ``rejects.REJECT``.
    """
    columns = list(columns)
    if mode not in ("lines", "split", "whole"):
        raise ValueError(f"mode must be 'lines', 'split' or 'whole', not {mode!r}")
    if not isinstance(paths, str):
        # Each path has its own header; one read would bind all files by the first.
        parts = [read_named_csv(spark, p, columns, mode=mode, placed=placed) for p in paths]
        return reduce(DataFrame.unionByName, parts)
    raw = (
        spark.read.option("header", True)
        # Files of one folder share their header; one that differs fails the job.
        .option("enforceSchema", False)
        .option("inferSchema", False)
        .option("multiLine", mode != "lines")
        .options(**OPTIONS)
        .csv(paths)
    )
    by_name = {name.lower(): name for name in raw.columns}
    missing = [name for name in columns if name.lower() not in by_name]
    if missing:
        raise ValueError(f"columns {missing} not found in the header of {paths}")
    chosen = [F.col(f"`{by_name[name.lower()]}`").alias(name) for name in columns]
    place = []
    if mode == "split":
        raw = _split(spark, paths, raw.columns, placed)
        place = [F.col(f"`{PLACE}`.{name}").alias(name) for name in ("file", "block", "row")]
    elif placed:
        place = [
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ]
    return raw.select(*chosen, *(place if placed else ()))


def _split(spark: SparkSession, path: str, names: list[str], placed: bool) -> DataFrame:
    """The columns ``names`` of all records but the header of each file, and their place."""
    records = read_quoted_records(spark, path, placed=placed).where("value != ''")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    is_header = (F.col("block") == 0) & (F.col("row") == 0)
    parsed = F.from_csv(_checked(F.col("value")), F.lit(schema.simpleString()), OPTIONS)
    rows = records.select(
        is_header.alias("is_header"),
        parsed.alias("record"),
        F.struct("file", "block", "row").alias(PLACE),
    )
    found = F.array(*[F.col("record").getField(name) for name in names])
    differs = F.raise_error(
        F.concat(
            F.lit(f"CSV header does not conform to the schema of {path}: "),
            F.concat_ws(",", found),
        )
    )
    expected = F.array(*[F.lit(name) for name in names])
    keep = F.when(~F.col("is_header"), True).when(found == expected, False).otherwise(differs)
    return rows.where(keep.cast("boolean")).select("record.*", f"`{PLACE}`")


def _checked(record: Column) -> Column:
    error = F.raise_error(
        F.concat(
            F.lit("quote within a field, read this input with mode='whole': "),
            F.substring(record, 1, 80),
        )
    )
    fine = ~record.contains('"') | record.rlike(_WELL_FORMED)
    return F.when(fine, record).otherwise(error.cast("string"))
