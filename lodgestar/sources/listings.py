"""Listings: one CSV file or folder per city."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgestar.functions import parsing
from lodgestar.schemas import LISTING_FIELDS, REQUIRED_LISTING_FIELDS
from lodgestar.sources.csv import read_named_csv
from lodgestar.sources.rejects import reason, reject


def _raw(
    spark: SparkSession, paths: dict[str, str], mode: str, placed: bool = False
) -> DataFrame:
    # The tag is a literal per input, so a filter on city removes the other inputs from the plan.
    per_city = [
        read_named_csv(spark, path, LISTING_FIELDS, mode=mode, placed=placed).withColumn(
            "city", F.lit(city)
        )
        for city, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, per_city)


def read_listings(
    spark: SparkSession,
    paths: dict[str, str],
    *,
    on_error: str = "fail",
    mode: str = "split",
    rejects: bool = False,
) -> DataFrame:
    """Typed listings of all cities with their ``city`` tag; ``paths`` maps city to file or folder.

    Titles may hold newlines. ``split`` reads a large file by many tasks all the same, ``whole`` is
    for files with stray quotes, see ``read_named_csv``. ``rejects`` (with ``on_error="null"``) adds
    the column ``reject``; all listings count, without the values that cannot be read.
    """
    raw = _raw(spark, paths, mode, rejects)
    typed = {
        name: parsing.cast(F.col(name), data_type, on_error)
        for name, (data_type, _) in LISTING_FIELDS.items()
    }
    told = []
    if rejects:
        parsing.check_lenient(on_error)
        faults = [
            reason(name, F.col(name), typed[name], required=required)
            for name, (_, required) in LISTING_FIELDS.items()
        ]
        line = F.to_csv(F.struct(*LISTING_FIELDS))
        told = [reject("listings", faults, line, F.lit(True))]
    return raw.select(*[value.alias(name) for name, value in typed.items()], "city", *told)


def rejected_listing_rows(
    spark: SparkSession, paths: dict[str, str], *, mode: str = "split"
) -> DataFrame:
    """Raw rows with a value that does not fit its type or a missing required value."""
    bad: Column = F.lit(False)
    for name, (data_type, required) in LISTING_FIELDS.items():
        value = F.col(name)
        if not isinstance(data_type, T.StringType):
            bad = bad | (value.isNotNull() & value.try_cast(data_type).isNull())
        if required:
            bad = bad | value.isNull()
    return _raw(spark, paths, mode).where(bad)


def required_field_nulls(listings: DataFrame) -> DataFrame:
    """Row count and, per required field, how many rows lack it (one row)."""
    return listings.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in REQUIRED_LISTING_FIELDS],
    )


def check_required(listings: DataFrame) -> DataFrame:
    """Same rows; a null in a required field, or a value that does not fit its type, fails the job.

    The check of the whole row is tied to ``id``, so it holds wherever the id is read, also if
    other fields are not used.
    """
    absent = [F.when(F.col(c).isNull(), F.lit(c)) for c in REQUIRED_LISTING_FIELDS]
    # Fields that may be null are read as well, since a strict cast fails only when it is read.
    read = [
        F.when(F.col(c).isNull() & F.col("id").isNull(), F.lit("id"))
        for c in listings.columns
        if c not in REQUIRED_LISTING_FIELDS
    ]
    missing = F.coalesce(*absent, *read)
    error = F.raise_error(F.concat(F.lit("listing without "), missing))
    return listings.withColumn("id", F.when(missing.isNotNull(), error).otherwise(F.col("id")))
