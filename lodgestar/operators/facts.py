"""Fact table: rated reviews, joined with listings and calendar, counted per group.

A review of a listing meets every calendar row of its listing and date, and a listing id may occur
several times. All measures are sums over these combinations, so each input is first summed per
join key and the combinations are multiplied out as counts. The joins then see each key once: no
listing, date or group of copies, however hot, makes more than one row per key, and no pairs are
materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FACT_KEYS = ["neighbourhood", "date", "host_id", "room_type"]


def review_days(rated: DataFrame) -> DataFrame:
    """Reviews per listing and date: reviews, rating_sum."""
    return rated.groupBy("listing_id", "date").agg(
        F.count(F.lit(1)).alias("reviews"), F.sum("rating").alias("rating_sum")
    )


def calendar_days(calendar: DataFrame) -> DataFrame:
    """Calendar rows per listing and date: entries, available_entries, entry_price_sum.

    The price sum is null where no row has a price.
    """
    return calendar.groupBy("listing_id", "date").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if("available").alias("available_entries"),
        F.sum("price").alias("entry_price_sum"),
    )


def listing_groups(listings: DataFrame, *, by_city: bool = False) -> DataFrame:
    """Listings per id and fact attributes: copies, listing_price_sum, declared_sum.

    ``by_city`` makes the city one of the attributes, and so a key of the facts.
    """
    return listings.groupBy(
        F.col("id").alias("listing_id"),
        "neighbourhood",
        F.col("host_id").cast("string").alias("host_id"),
        "room_type",
        *(["city"] if by_city else []),
    ).agg(
        F.count(F.lit(1)).alias("copies"),
        F.sum(F.col("price").cast("double")).alias("listing_price_sum"),
        F.sum("number_of_reviews").alias("declared_sum"),
    )


def fact_keys(groups: DataFrame) -> list[str]:
    """Keys of the facts made from listing groups: with the city where the groups have it."""
    return [*FACT_KEYS, *(["city"] if "city" in groups.columns else [])]


def stable_id(*keys: str) -> Column:
    """Key-based row id: the same in every run, so a repeated load makes no new ids."""
    parts = [F.coalesce(F.col(key).cast("string"), F.lit("\\N")) for key in keys]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def combine_days(
    review_day: DataFrame, calendar_day: DataFrame, listing_group: DataFrame
) -> DataFrame:
    """Measures per listing, attributes and date.

    Both day frames come out of an aggregation on (listing_id, date) or a table bucketed by listing,
    so their join needs no further shuffle. Without a calendar row the listing counts as available
    at its own price; with one, the calendar decides, and its missing price stays missing.
    """
    joined = review_day.join(calendar_day, ["listing_id", "date"], "left").join(
        listing_group, "listing_id"
    )
    matched = F.col("entries").isNotNull()
    stays = F.col("reviews") * F.col("copies")
    entries = F.coalesce("entries", F.lit(1))
    available = F.coalesce("available_entries", F.lit(1))
    return joined.select(
        "listing_id",
        *fact_keys(listing_group),
        (stays * available).alias("available"),
        (stays * (entries - available)).alias("not_available"),
        F.when(matched, stays * F.col("entry_price_sum"))
        .otherwise(F.col("reviews") * F.col("listing_price_sum"))
        .alias("price_sum"),
        (F.col("rating_sum") * F.col("copies") * entries).alias("rating_sum"),
        (F.col("reviews") * entries * F.col("declared_sum")).alias("declared"),
    )


def fact_from_days(
    review_day: DataFrame,
    calendar_day: DataFrame,
    listing_group: DataFrame,
    *,
    row_id: str = "stable",
    first_id: Column | None = None,
) -> DataFrame:
    """Fact rows from already summed inputs, see ``fact_reviews``.

    ``first_id`` is the smallest number that a run's ids may have.
    """
    keys = fact_keys(listing_group)
    number = F.monotonically_increasing_id()
    number = number if first_id is None else number + first_id
    ids = {"stable": stable_id(*keys), "run": number.cast("string")}
    if row_id not in ids:
        raise ValueError(f"row_id must be one of {sorted(ids)}, not {row_id!r}")
    facts = (
        combine_days(review_day, calendar_day, listing_group)
        .groupBy(*keys)
        .agg(
            F.sum("available").alias("available_listings_count"),
            F.sum("not_available").alias("not_available_listings_count"),
            F.sum("price_sum").alias("prices_sum"),
            F.sum("rating_sum").alias("ratings_sum"),
            F.sum("declared").alias("declared_reviews_count"),
        )
    )
    # The city comes last, so that the other columns keep their places.
    columns = [name for name in facts.columns if name != "city"] + keys[len(FACT_KEYS) :]
    return facts.select(ids[row_id].alias("id"), *columns)


def fact_reviews(
    rated: DataFrame, listings: DataFrame, calendar: DataFrame, *, row_id: str = "stable"
) -> DataFrame:
    """One row per neighbourhood, date, host and room type.

    ``row_id="stable"`` hashes the group key, ``"run"`` numbers the rows of this run.
    """
    return fact_from_days(
        review_days(rated), calendar_days(calendar), listing_groups(listings), row_id=row_id
    )


def join_reviews_listings(rated: DataFrame, listings: DataFrame) -> DataFrame:
    """Each review with its listing's attributes; reviews of unlisted properties are lost.

    Equal copies of a listing are one row with their number in ``copies``, so reviews and copies of
    one hot listing are not paired. A listing that holds a large share of the reviews is split over
    tasks by AQE's skew join.
    """
    attributes = listings.groupBy(
        F.col("id").alias("listing_id"),
        "neighbourhood",
        F.col("host_id").cast("string").alias("host_id"),
        "room_type",
        F.col("price").cast("double").alias("price"),
        "number_of_reviews",
    ).agg(F.count(F.lit(1)).alias("copies"))
    return rated.join(attributes, "listing_id")


def review_states(rated: DataFrame, listings: DataFrame, calendar: DataFrame) -> DataFrame:
    """Reviews left-joined with the calendar: listing_id, date, available, price, joined_rows.

    Equal joined rows are given once, with their number.
    """
    reviews = rated.groupBy("listing_id", "date").agg(F.count(F.lit(1)).alias("reviews"))
    states = calendar.groupBy("listing_id", "date", "available", "price").agg(
        F.count(F.lit(1)).alias("entries")
    )
    prices = listings.groupBy(
        F.col("id").alias("listing_id"), F.col("price").cast("double").alias("listing_price")
    ).agg(F.count(F.lit(1)).alias("copies"))
    # Behind a calendar row the listing's own price does not count, only how often it is listed. Each
    # joined row is then made once, so no further sum has to hold them all.
    listed = prices.groupBy("listing_id").agg(F.sum("copies").alias("copies"))
    by_match = prices.withColumn("matched", F.lit(False)).unionByName(
        listed.withColumns(
            {"listing_price": F.lit(None).cast("double"), "matched": F.lit(True)}
        )
    )
    joined = (
        reviews.join(states, ["listing_id", "date"], "left")
        .withColumn("matched", F.col("entries").isNotNull())
        .join(by_match, ["listing_id", "matched"])
    )
    matched = F.col("matched")
    return joined.select(
        "listing_id",
        "date",
        F.when(matched, F.col("available")).otherwise(F.lit(True)).alias("available"),
        F.when(matched, F.col("price")).otherwise(F.col("listing_price")).alias("price"),
        (F.col("reviews") * F.col("copies") * F.coalesce("entries", F.lit(1))).alias("joined_rows"),
    )
