"""The three analyses over the star schema; choices of a reader are parameters."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgestar.operators.star import (
    Star,
    join_date,
    join_host,
    join_neighbourhood,
    join_room_type,
    pivot_by_room_type,
    ratio_of_sums,
    review_count,
    room_types,
    top_k_per_group,
)

# Fixed value: a host needs more reviews than this in the latest year.
MIN_REVIEWS = 30
BEST_HOSTS = 2


def _of_city(frame: DataFrame, city: str | None) -> DataFrame:
    # ``city`` is a grouping key below, so Catalyst moves this filter to the dimension scan.
    return frame if city is None else frame.where(F.col("city") == city).drop("city")


def _by_room_type(
    star: Star, period: str, value: Column, values: Sequence[str] | None, months: Sequence[int] | None
) -> DataFrame:
    joined = join_room_type(join_date(join_neighbourhood(star.fact, star), star), star)
    if months is not None:
        joined = joined.where(F.col("month").isin(*[int(month) for month in months]))
    return pivot_by_room_type(
        joined, ["city", period], value, room_types(star) if values is None else values
    )


def reviews_by_year(
    star: Star, city: str | None = None, values: Sequence[str] | None = None
) -> DataFrame:
    """Reviews per year, one column per room type; of one city, or of all with a city column.

    ``values`` names the room types; by default they are read from the dimension.
    """
    table = _by_room_type(star, "year", F.sum(review_count()), values, None)
    return _of_city(table, city).orderBy("year")


def avg_price_by_month(
    star: Star,
    city: str | None = None,
    months: Sequence[int] | None = None,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Average price per month (all, or those given), one column per room type.

    Reviews without a known price count in the divisor.
    """
    price = ratio_of_sums(F.col("prices_sum"), review_count())
    return _of_city(_by_room_type(star, "month", price, values, months), city)


def _host_facts(star: Star) -> DataFrame:
    return join_date(join_neighbourhood(star.fact, star), star).where(F.col("host_id").isNotNull())


def _host_sums(host_facts: DataFrame) -> DataFrame:
    return host_facts.groupBy("city", "group", "year", "host_id").agg(
        F.sum("ratings_sum").alias("ratings_sum"), F.sum(review_count()).alias("reviews")
    )


def _rated_hosts(sums: DataFrame, star: Star) -> DataFrame:
    return join_host(sums, star).select(
        "city",
        "group",
        "year",
        F.col("host_id").alias("id"),
        F.col("host_name").alias("name"),
        F.round(F.round(F.try_divide("ratings_sum", "reviews"), 10), 2).alias("avg_rating"),
        F.col("reviews").alias("number_of_reviews"),
    )


def host_ratings(star: Star) -> DataFrame:
    """Per city, group, year and host: avg_rating (two decimals) and number_of_reviews.

    Facts are summed per host id first, so that a large host dimension is joined with sums, not
    with facts. The noise of summing doubles in any order is cut off before the two decimals are
    taken, so that a tie is rounded up in every run.
    """
    return _rated_hosts(_host_sums(_host_facts(star)), star)


def latest_year_hosts(
    star: Star, city: str | None = None, min_reviews: int = MIN_REVIEWS
) -> DataFrame:
    """Hosts with more than ``min_reviews`` reviews in their city's latest year.

    A year counts if a host of the dimension has reviews in it. For all cities the facts are read
    once: the sums per host and year give the latest years and the ratings, and both use the same
    shuffle. For one city the latest year is a subquery on few columns, so that the second read
    skips the partitions of all other years. Nothing is fetched to the driver.
    """
    host_facts = _host_facts(star).where("city IS NOT NULL AND year IS NOT NULL")
    if city is None:
        sums = _host_sums(host_facts)
        # Both sums are used on this side too, so that the plans up to the shuffle are the same.
        seen = F.col("reviews").isNotNull() | F.col("ratings_sum").isNotNull()
        last = join_host(sums, star).groupBy("city").agg(F.max(F.when(seen, F.col("year"))).alias("year"))
        latest = _rated_hosts(sums.join(last, ["city", "year"]), star)
    else:
        host_facts = host_facts.where(F.col("city") == city)
        last = host_facts.groupBy("host_id").agg(F.max("year").alias("year"))
        year = join_host(last, star).agg(F.max("year")).scalar()
        latest = _rated_hosts(_host_sums(host_facts.where(F.col("year") == year)), star)
    return latest.where(F.col("number_of_reviews") > min_reviews)


#: Rank of hosts: column, and whether large values come first.
HOST_ORDER = {"avg_rating": True, "number_of_reviews": False, "id": False}
#: Result columns after the city, and what they are called in the ratings.
HOST_COLUMNS = {
    "neighbourhood": "group",
    "name": "name",
    "avg_rating": "avg_rating",
    "number_of_reviews": "number_of_reviews",
}


def _host_columns(city: str | None) -> dict[str, str]:
    return HOST_COLUMNS if city is not None else {"city": "city", **HOST_COLUMNS}


def top_hosts(
    star: Star, city: str | None = None, min_reviews: int = MIN_REVIEWS, k: int = BEST_HOSTS
) -> DataFrame:
    """The ``k`` best-rated hosts per group in the latest year.

    At equal rating fewer reviews rank first, then the smaller host id.
    """
    hosts = latest_year_hosts(star, city, min_reviews)
    order = [F.desc(name) if down else F.asc(name) for name, down in HOST_ORDER.items()]
    best = top_k_per_group(hosts, ["city", "group"], order, k)
    columns = [F.col(source).alias(name) for name, source in _host_columns(city).items()]
    return best.select(*columns).orderBy(F.desc("neighbourhood"))


def top_hosts_sql(
    spark: SparkSession,
    star: Star,
    city: str | None = None,
    min_reviews: int = MIN_REVIEWS,
    k: int = BEST_HOSTS,
) -> DataFrame:
    """``top_hosts`` as a SQL statement over a temp view, whose name is new in every call."""
    view = f"rated_hosts_{uuid.uuid4().hex}"
    latest_year_hosts(star, city, min_reviews).createOrReplaceTempView(view)
    rank = ", ".join(f"{name} {'DESC' if down else 'ASC'}" for name, down in HOST_ORDER.items())
    columns = ", ".join(f"`{source}` AS {name}" for name, source in _host_columns(city).items())
    best = spark.sql(
        f"""
        WITH placed AS (
            SELECT *, row_number() OVER hosts_of_group AS place
            FROM {view}
            WINDOW hosts_of_group AS (PARTITION BY city, `group` ORDER BY {rank})
        )
        SELECT {columns} FROM placed WHERE place <= :k ORDER BY neighbourhood DESC
        """,
        args={"k": k},
    )
    best.columns  # resolves the statement, so that the view is no longer needed
    spark.catalog.dropTempView(view)
    return best
