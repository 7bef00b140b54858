"""Availability calendar: CSV with one row per listing and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgestar.functions import parsing
from lodgestar.schemas import CALENDAR_FIELDS
from lodgestar.sources.csv import read_named_csv
from lodgestar.sources.rejects import reason, reject


def _raw(
    spark: SparkSession, paths: str | list[str], multi_line: bool, placed: bool = False
) -> DataFrame:
    mode = "split" if multi_line else "lines"
    return read_named_csv(spark, paths, CALENDAR_FIELDS, mode=mode, placed=placed)


def read_calendar(
    spark: SparkSession,
    paths: str | list[str],
    *,
    on_error: str = "fail",
    multi_line: bool = False,
    rejects: bool = False,
) -> DataFrame:
    """Typed calendar rows of all inputs in one scan.

    No calendar field is free text, so by default rows are lines and large files are split over
    the cluster. ``multi_line`` also accepts newlines inside quoted fields, at a second scan.
    ``rejects`` (with ``on_error="null"``) adds the column ``reject``; rows without listing or date
    do not count, those without a readable price do.
    """
    raw = _raw(spark, paths, multi_line, rejects)
    listing_id = parsing.cast(F.col("listing_id"), "long", on_error)
    if on_error == "fail":
        listing_id = parsing.required(listing_id, "listing_id of a calendar row")
    date = parsing.iso_date(F.col("date"), on_error)
    price = parsing.money(F.col("price"), on_error)
    told = []
    if rejects:
        parsing.check_lenient(on_error)
        faults = [
            reason("listing_id", F.col("listing_id"), listing_id),
            reason("date", F.col("date"), date),
            reason("price", F.col("price"), price, required=False),
        ]
        kept = listing_id.isNotNull() & date.isNotNull()
        told = [reject("calendar", faults, F.to_csv(F.struct(*CALENDAR_FIELDS)), kept)]
    return raw.select(
        listing_id.alias("listing_id"),
        date.alias("date"),
        parsing.flag(F.col("available")).alias("available"),
        price.alias("price"),
        *told,
    )


def rejected_calendar_rows(
    spark: SparkSession, paths: str | list[str], *, multi_line: bool = False
) -> DataFrame:
    """Raw rows whose id, date or price cannot be read."""
    raw = _raw(spark, paths, multi_line)
    return raw.where(
        F.col("listing_id").try_cast("long").isNull()
        | parsing.iso_date(F.col("date"), "null").isNull()
        | (F.col("price").isNotNull() & parsing.money(F.col("price"), "null").isNull())
    )
