"""The four dimension tables.

One aggregation over all cities replaces per-city de-duplication: its map side already removes the
copies within each input. Where several rows share a key, the smallest value is kept, so two runs
give the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgestar.functions.parsing import date_parts


def dim_room_type(listings: DataFrame) -> DataFrame:
    return listings.select("room_type").distinct()


def dim_host(listings: DataFrame) -> DataFrame:
    """One row per host id."""
    return listings.groupBy(F.col("host_id").cast("string").alias("id")).agg(
        F.min("host_name").alias("name")
    )


def dim_neighbourhood(listings: DataFrame, *, by_city: bool = False) -> DataFrame:
    """One row per neighbourhood name over all cities: the first by city, then by group.

    ``by_city`` keeps one row per name and city, for facts that hold the city.
    """
    name = F.col("neighbourhood").alias("name")
    if by_city:
        group = F.min("neighbourhood_group").alias("group")
        return listings.groupBy(name, "city").agg(group).select("name", "group", "city")
    first = F.min(F.struct("city", "neighbourhood_group")).alias("first")
    return (
        listings.groupBy(name)
        .agg(first)
        .select("name", F.col("first.neighbourhood_group").alias("group"), "first.city")
    )


def dim_date(*dated: DataFrame) -> DataFrame:
    """Every date of the given frames once, with its parts."""
    dates = dated[0].select("date")
    for frame in dated[1:]:
        dates = dates.union(frame.select("date"))
    return dates.distinct().select("date", *date_parts(F.col("date")))
