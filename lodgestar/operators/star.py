"""Star joins and the aggregates used on top of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Star:
    """The fact table and its dimensions. Dimension keys are unique."""

    fact: DataFrame
    neighbourhood: DataFrame
    date: DataFrame
    room_type: DataFrame
    host: DataFrame

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str | None = None) -> Star:
        prefix = f"`{database}`." if database else ""
        tables = ("tof_reviews", "dim_neighbourhood", "dim_date", "dim_room_type", "dim_host")
        return cls(*[spark.table(prefix + name) for name in tables])


def review_count() -> Column:
    """Joined review rows behind a fact row."""
    return F.col("available_listings_count") + F.col("not_available_listings_count")


def join_neighbourhood(facts: DataFrame, star: Star) -> DataFrame:
    """Adds city and group. Facts that hold the city are joined on it as well."""
    dimension = star.neighbourhood.withColumnRenamed("name", "neighbourhood")
    on = ["neighbourhood", "city"] if "city" in facts.columns else ["neighbourhood"]
    return facts.join(dimension, on)


def join_date(facts: DataFrame, star: Star) -> DataFrame:
    """Adds day, month and year.

    A fact table partitioned by year is joined on the year as well, so that a filter on the
    dimension's year skips partitions.
    """
    on = ["date", "year"] if "year" in facts.columns else ["date"]
    return facts.join(star.date, on)


def join_room_type(facts: DataFrame, star: Star) -> DataFrame:
    return facts.join(star.room_type, "room_type")


def join_host(facts: DataFrame, star: Star) -> DataFrame:
    """Adds host_name."""
    dimension = star.host.select(F.col("id").alias("host_id"), F.col("name").alias("host_name"))
    return facts.join(dimension, "host_id")


def star_join(star: Star) -> DataFrame:
    """Fact rows with all dimension attributes; rows without a partner drop out.

    Joins carry no hint: Spark broadcasts a dimension by its measured size and shuffles a larger
    one (hosts may be many).
    """
    facts = join_date(join_neighbourhood(star.fact, star), star)
    return join_host(join_room_type(facts, star), star)


def ratio_of_sums(numerator: Column, denominator: Column) -> Column:
    """Ratio of two sums; null where the divisor is zero. Nulls count only in the divisor."""
    return F.try_divide(F.sum(numerator), F.sum(denominator))


def room_types(star: Star) -> list[str]:
    """Room types for the columns of a pivot: one small job on the dimension, not on the facts.

    Spark's own bound on pivot columns applies.
    """
    limit = int(star.room_type.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = star.room_type.where("room_type IS NOT NULL").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} room types, see spark.sql.pivotMaxValues")
    return sorted(row[0] for row in rows)


def pivot_by_room_type(
    joined: DataFrame, keys: Sequence[str], value: Column, values: Sequence[str]
) -> DataFrame:
    """One row per key, one column per room type; missing cells are null."""
    return joined.groupBy(*keys).pivot("room_type", list(values)).agg(value)


def top_k_per_group(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    """First ``k`` rows of each group in the given order.

    Spark turns the rank filter into a limit before the shuffle, so a hot group sends at most
    ``k`` rows per task.
    """
    ranked = rows.withColumn("rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rn") <= k).drop("rn")
