"""Warehouse tables and their load."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lodgestar.functions import parsing
from lodgestar.operators import dimensions, facts
from lodgestar.operators.sentiment import rate_reviews
from lodgestar.plans.merge import (
    in_written_order,
    insert_rows,
    merge_dimension,
    merge_facts,
    table_name,
)
from lodgestar.schemas import REJECT_COLUMNS, WAREHOUSE_TABLES
from lodgestar.session import run_together
from lodgestar.sources import (
    RawLayout,
    check_required,
    read_calendar,
    read_lexicon,
    read_listings,
    read_reviews,
)
from lodgestar.sources.rejects import both_ways
from lodgestar.staging import Staging, settings

FACT_TABLE = "tof_reviews"
REJECT_TABLE = "rejected_rows"


def create_warehouse(
    spark: SparkSession,
    database: str | None = None,
    *,
    location: str | None = None,
    file_format: str = "orc",
    fact_by_year: bool = False,
    fact_by_city: bool = False,
) -> None:
    """Drop and create the five tables, and that of rejected rows.

    ``fact_by_year`` adds a ``year`` partition column to the fact table, for analyses of single
    years over a large history. ``fact_by_city`` adds the city to the facts and to the key of the
    neighbourhoods, for names that several cities have. ``location`` is the folder of a new database.
    """
    if file_format not in ("orc", "parquet"):
        raise ValueError(f"file_format must be 'orc' or 'parquet', not {file_format!r}")
    if database:
        place = f" LOCATION '{location}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
    for name, columns in {**WAREHOUSE_TABLES, REJECT_TABLE: REJECT_COLUMNS}.items():
        partitioned = fact_by_year and name == FACT_TABLE
        if fact_by_city and name == FACT_TABLE:
            columns = [*columns, ("city", "string")]
        if partitioned:
            columns = [*columns, ("year", "int")]
        ddl = ", ".join(f"`{column}` {sql_type}" for column, sql_type in columns)
        spark.sql(f"DROP TABLE IF EXISTS {table_name(database, name)}")
        spark.sql(
            f"CREATE TABLE {table_name(database, name)} ({ddl}) USING {file_format}"
            + (" PARTITIONED BY (`year`)" if partitioned else "")
        )


@dataclass(frozen=True)
class Inputs:
    """Typed inputs of a load. Listings, calendar and reviews may have a column ``reject``."""

    listings: DataFrame
    calendar: DataFrame
    reviews: DataFrame
    lexicon: DataFrame

    @classmethod
    def from_files(
        cls,
        spark: SparkSession,
        layout: RawLayout,
        positive_words: str | list[str],
        negative_words: str | list[str],
        *,
        review_mode: str = "split",
        listing_mode: str = "split",
        review_prefix: str = parsing.REVIEW_PREFIX,
        on_error: str = "fail",
        normalize_lexicon: bool = False,
    ) -> Inputs:
        """``on_error="null"`` reads malformed values as null and tells the rows they are in."""
        lenient = on_error == "null"
        options = {"on_error": on_error, "rejects": lenient}
        listings = read_listings(spark, layout.listings(), mode=listing_mode, **options)
        return cls(
            listings if lenient else check_required(listings),
            read_calendar(spark, layout.calendars(), **options),
            read_reviews(
                spark, layout.reviews(), mode=review_mode, prefix=review_prefix, **options
            ),
            read_lexicon(spark, positive_words, negative_words, normalize=normalize_lexicon),
        )


@dataclass(frozen=True)
class Counts:
    """Rows of one input as the job that staged them counted: all, with a fault, and left out."""

    rows: int
    rejected: int
    left_out: int


LISTING_COLUMNS = (
    "id",
    "host_id",
    "host_name",
    "neighbourhood_group",
    "neighbourhood",
    "city",
    "room_type",
    "price",
    "number_of_reviews",
)


class _Loading:
    """The inputs of one load, staged in one pass each."""

    def __init__(self, staging: Staging) -> None:
        self.staging = staging
        self.observed: dict[str, Observation] = {}
        self.rejects: list[DataFrame] = []

    def _staged(
        self,
        name: str,
        rows: DataFrame,
        sums: Callable[[DataFrame], DataFrame],
        key: str,
        where: str = "listing_id IS NOT NULL AND date IS NOT NULL",
        told_by: Sequence[str] = (),
        rated: Callable[[DataFrame], DataFrame] = lambda r: r,
    ) -> DataFrame:
        """What ``sums`` makes of the rows that count, bucketed by ``key``.

        Rejected rows are written by the task that read them, into a partition of their own beside
        those that count. Their raw text is most of what a faulty input is, so it is neither
        shuffled nor sorted; ``rated`` may shuffle nothing. ``told_by`` are columns it needs of all rows.
        """
        fault = F.col("reject").isNotNull() if "reject" in rows.columns else F.lit(False)
        left_out = fault & ~F.col("reject.kept") if "reject" in rows.columns else F.lit(False)
        self.observed[name] = Observation(name)
        rows = rows.observe(
            self.observed[name],
            F.count(F.lit(1)).alias("rows"),
            F.count_if(fault).alias("rejected"),
            F.count_if(left_out).alias("left_out"),
        )
        if "reject" not in rows.columns:
            return self.staging.write(sums(rated(rows.where(where))), name, bucket_by=key)
        told = rated(both_ways(rows, *told_by))
        told = told.withColumn("rejected", F.col("reject").isNotNull())
        read = self.staging.write(
            told, f"{name}_read", partition_by=["rejected"], compression="zstd"
        )
        self.rejects.append(read.where("rejected").select("reject.*"))
        counted = read.where("NOT rejected").drop("rejected", "reject")
        return self.staging.write(sums(counted), name, bucket_by=key)

    def listings(self, rows: DataFrame) -> DataFrame:
        told = [name for name in rows.columns if name == "reject"]
        rows = rows.select(*LISTING_COLUMNS, *told)
        return self._staged("listings", rows, lambda r: r, "id", where="true")

    def calendar(self, rows: DataFrame) -> DataFrame:
        return self._staged("calendar", rows, facts.calendar_days, "listing_id")

    def reviews(self, rows: DataFrame, lexicon: DataFrame) -> DataFrame:
        def rated(reviews: DataFrame) -> DataFrame:
            in_task = "reject" in reviews.columns
            return rate_reviews(reviews, lexicon, in_task=in_task).drop("review_id")

        return self._staged(
            "reviews", rows, facts.review_days, "listing_id", told_by=["review_id"], rated=rated
        )

    def counts(self) -> dict[str, Counts]:
        return {name: Counts(**seen.get) for name, seen in sorted(self.observed.items())}


def load_warehouse(
    spark: SparkSession,
    inputs: Inputs,
    database: str | None = None,
    *,
    overwrite: bool = True,
    merge: bool = False,
    row_id: str = "stable",
) -> dict[str, Counts]:
    """Fill the dimensions and the fact table; returns the rows of each input.

    By default the new rows replace the old ones; ``overwrite=False`` adds them as they are. With
    ``merge`` dimension keys stay unique and facts of equal key are summed, so that loads of
    disjoint reviews, each with the listings and calendar rows of its reviews, give in any order
    what one load of all would.

    Listings are staged as parsed, reviews and calendar as sums per listing and date: that is all
    the dates and the facts need, and much less than the raw text. All three are bucketed by
    listing, so their joins shuffle nothing. The staged tables are dropped when the load ends or
    fails. Reviews and calendar rows without a listing or date have no key and are left out. Rows of
    lenient inputs with any fault go to the table of rejected rows, written by the same pass over
    the raw files.
    """
    if merge and row_id != "stable":
        raise ValueError("facts are merged by their stable ids")
    with Staging(spark) as staging:
        # Once written, the lexicon's measured size decides whether it is broadcast.
        lexicon = staging.write(inputs.lexicon, "lexicon")
        loading = _Loading(staging)
        # Rows that count and rejected ones are written as they come, without a sort to part them.
        with settings(spark, spark__sql__maxConcurrentOutputFileWriters="2"):
            listings, review_day, calendar_day = run_together(
                spark,
                partial(loading.listings, inputs.listings),
                partial(loading.reviews, inputs.reviews, lexicon),
                partial(loading.calendar, inputs.calendar),
            )
        # Joins on listing and date may use the buckets of the listing.
        with settings(spark, spark__sql__requireAllClusterKeysForCoPartition="false"):
            _fill(spark, staging, database, listings, review_day, calendar_day, overwrite, merge, row_id)
            if loading.rejects and spark.catalog.tableExists(table_name(database, REJECT_TABLE)):
                listed = reduce(DataFrame.unionByName, loading.rejects)
                insert_rows(listed, REJECT_TABLE, database, overwrite=overwrite and not merge)
        return loading.counts()


def _fill(
    spark: SparkSession,
    staging: Staging,
    database: str | None,
    listings: DataFrame,
    review_day: DataFrame,
    calendar_day: DataFrame,
    overwrite: bool,
    merge: bool,
    row_id: str,
) -> None:
    by_city = "city" in spark.table(table_name(database, FACT_TABLE)).columns
    if merge and by_city:
        raise ValueError("facts by city are replaced or appended, not merged")
    dimension_rows = {
        "dim_room_type": dimensions.dim_room_type(listings),
        "dim_neighbourhood": dimensions.dim_neighbourhood(listings, by_city=by_city),
        "dim_date": dimensions.dim_date(calendar_day, review_day),
        "dim_host": dimensions.dim_host(listings),
    }
    dimension_rows = {name: in_written_order(name, rows) for name, rows in dimension_rows.items()}
    first_id = None
    if row_id == "run" and not overwrite:
        first_id = next_run_id(spark, database)
    fact_rows = facts.fact_from_days(
        review_day,
        calendar_day,
        facts.listing_groups(listings, by_city=by_city),
        row_id=row_id,
        first_id=first_id,
    )
    if merge:
        run_together(
            spark,
            *[
                partial(merge_dimension, staging, rows, name, database)
                for name, rows in dimension_rows.items()
            ],
            partial(merge_facts, staging, fact_rows, FACT_TABLE, database),
        )
        return
    run_together(
        spark,
        *[
            partial(insert_rows, rows, name, database, overwrite=overwrite)
            for name, rows in dimension_rows.items()
        ],
        partial(
            insert_rows,
            fact_rows,
            FACT_TABLE,
            database,
            overwrite=overwrite,
            stable_ids=row_id == "stable",
        ),
    )


def next_run_id(spark: SparkSession, database: str | None = None) -> Column:
    """One more than the largest number among the fact ids, so that runs share no id."""
    ids = spark.table(table_name(database, FACT_TABLE)).select(F.col("id").try_cast("long"))
    return F.coalesce(ids.agg(F.max("id") + 1).scalar(), F.lit(0))
