"""One Spark query per operator or group of operators, over the frames of the given tables.

Sums of doubles are rounded, as the order of summation is open.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgestar.functions import parsing
from lodgestar.operators import dimensions, facts, sentiment
from lodgestar.operators.star import (
    Star,
    join_date,
    join_neighbourhood,
    review_count,
    star_join,
)
from lodgestar.plans import analyses, warehouse
from lodgestar.session import scratch_path, stage
from lodgestar.sources import (
    check_required,
    parse_reviews,
    read_calendar,
    read_lexicon,
    read_listings,
    read_reviews,
    rejected_calendar_rows,
    required_field_nulls,
)
from validation.frames import Frames, new_database

CITY = "EUROPE"
MONTHS = [1, 6, 7, 10]
# A host has far fewer stays here than in a real city, so the analysis' default of 30 finds none.
MIN_REVIEWS = 8
# Reviews in a raw file, about 16 MB of text.
RECORDS_PER_FILE = 5000

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(function: Callable[[Frames], DataFrame]) -> Callable[[Frames], DataFrame]:
    _queries[function.__name__] = lambda spark, folder: function(Frames(spark, folder))
    return function


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def _rounded(name: str, digits: int = 4) -> Column:
    return F.round(F.col(name), digits).alias(name)


# --- raw files ----------------------------------------------------------------------------------


def _write_listings(frames: Frames, listings: DataFrame | None = None) -> dict[str, str]:
    path = scratch_path(frames.spark, "raw-listings")
    options = {"header": True, "quote": '"', "escape": '"'}
    rows = frames.listings if listings is None else listings
    rows.write.partitionBy("city").options(**options).csv(path)
    return {city: f"{path}/city={city}" for city in frames.cities}


def _raw_calendar(frames: Frames) -> DataFrame:
    return frames.calendar.select(
        F.col("listing_id").cast("string").alias("listing_id"),
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.when(F.col("available"), F.lit("t")).otherwise(F.lit("f")).alias("available"),
        F.concat(F.lit("$"), F.format_number("price", 2)).alias("price"),
    )


def _unpadded(frames: Frames) -> DataFrame:
    """Calendar rows in which dates of unavailable days lack their padding."""
    date = F.when(F.col("available") == "f", F.lit("2018-1-2")).otherwise(F.col("date"))
    return _raw_calendar(frames).withColumn("date", date)


def _write_calendar(frames: Frames, calendar: DataFrame | None = None) -> str:
    path = scratch_path(frames.spark, "raw-calendar")
    rows = _raw_calendar(frames) if calendar is None else calendar
    rows.write.options(header=True, quote='"', escape='"').csv(path)
    return path


def _write_reviews(frames: Frames, records: DataFrame | None = None) -> str:
    path = scratch_path(frames.spark, "raw-reviews")
    rows = frames.review_records if records is None else records
    # Texts of one document follow each other, so they pack well; files stay small, as a packed
    # file, like one that is read as a whole, is read by one task.
    options = {"compression": "lz4", "maxRecordsPerFile": RECORDS_PER_FILE}
    rows.select("value").write.options(**options).text(path)
    return path


def _write_lexicon(frames: Frames) -> tuple[str, str]:
    paths = []
    for name, words in zip(("positive", "negative"), frames.lexicon_words, strict=True):
        paths.append(scratch_path(frames.spark, f"raw-{name}-words"))
        words.distinct().write.text(paths[-1])
    return paths[0], paths[1]


@query
def scan_listings_csv(frames: Frames) -> DataFrame:
    return read_listings(frames.spark, _write_listings(frames))


@query
def scan_listings_csv_whole(frames: Frames) -> DataFrame:
    return read_listings(frames.spark, _write_listings(frames), mode="whole")


@query
def scan_calendar_csv(frames: Frames) -> DataFrame:
    return read_calendar(frames.spark, _write_calendar(frames))


@query
def scan_review_text_whole(frames: Frames) -> DataFrame:
    reviews = read_reviews(frames.spark, _write_reviews(frames), mode="whole")
    return reviews.select("listing_id", "date", "comment")


@query
def scan_review_text_split(frames: Frames) -> DataFrame:
    reviews = read_reviews(frames.spark, _write_reviews(frames), mode="split")
    return reviews.select("listing_id", "date", "comment")


@query
def load_lexicon(frames: Frames) -> DataFrame:
    return read_lexicon(frames.spark, *_write_lexicon(frames))


# --- parsing ------------------------------------------------------------------------------------


@query
def parse_money(frames: Frames) -> DataFrame:
    raw = frames.table("lineitem").select(
        "l_orderkey",
        F.when(
            F.col("l_returnflag") != "R",
            F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)),
        ).alias("raw"),
    )
    return raw.select("l_orderkey", parsing.money(F.col("raw")).alias("price"))


@query
def parse_flag(frames: Frames) -> DataFrame:
    raw = frames.table("lineitem").select(
        "l_orderkey",
        F.when(F.col("l_linestatus") == "O", F.lit("t"))
        .when(F.col("l_returnflag") == "A", F.lit("T"))
        .when(F.col("l_returnflag") == "N", F.lit("f"))
        .alias("raw"),
    )
    return raw.select("l_orderkey", parsing.flag(F.col("raw")).alias("available"))


@query
def parse_date_parts(frames: Frames) -> DataFrame:
    raw = frames.table("orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("raw")
    )
    dated = raw.select("o_orderkey", parsing.iso_date(F.col("raw")).alias("date"))
    return dated.select("o_orderkey", "date", *parsing.date_parts(F.col("date")))


@query
def review_extract(frames: Frames) -> DataFrame:
    """The pattern on texts with quotes and line breaks of their own."""
    return parse_reviews(frames.awkward_records).select("listing_id", "date", "comment")


@query
def required_nulls(frames: Frames) -> DataFrame:
    holes = frames.listings.withColumn(
        "price", F.when(F.col("room_type") != "BUILDING", F.col("price"))
    )
    return required_field_nulls(holes)


@query
def strict_listings(frames: Frames) -> DataFrame:
    return check_required(frames.listings).select("id", "host_id", "price", "number_of_reviews")


@query
def rejected_rows(frames: Frames) -> DataFrame:
    """Calendar file in which dates of unavailable days lack their padding."""
    path = _write_calendar(frames, _unpadded(frames))
    return rejected_calendar_rows(frames.spark, path).select("listing_id", "date", "available")


# --- rating -------------------------------------------------------------------------------------


@query
def sentiment_rating(frames: Frames) -> DataFrame:
    return frames.rated_documents.select("doc_id", "positive", "negative", _rounded("rating", 10))


@query
def sentiment_large_lexicon(frames: Frames) -> DataFrame:
    """The way for a lexicon above the broadcast threshold.

    Nearly all words of the texts are in this one, so the texts are dealt by key first: the words of
    a text, several times as much, are then counted where they are, and only move to the lexicon.
    """
    documents = frames.table("documents").select("doc_id", "text").repartition("doc_id")
    rated = sentiment.rate_texts(
        documents, frames.large_lexicon, key="doc_id", text="text", prefilter=True
    )
    return rated.select("doc_id", "positive", "negative", _rounded("rating", 10))


@query
def rate_extracted_reviews(frames: Frames) -> DataFrame:
    rated = sentiment.rate_reviews(parse_reviews(frames.review_records), frames.lexicon)
    return rated.select("listing_id", "date", _rounded("rating", 10))


# --- dimensions ---------------------------------------------------------------------------------


@query
def dim_room_type(frames: Frames) -> DataFrame:
    return dimensions.dim_room_type(frames.listings)


@query
def dim_host(frames: Frames) -> DataFrame:
    return dimensions.dim_host(frames.listings)


@query
def dim_neighbourhood(frames: Frames) -> DataFrame:
    return dimensions.dim_neighbourhood(frames.listings)


@query
def dim_date(frames: Frames) -> DataFrame:
    return frames.dates


# --- facts --------------------------------------------------------------------------------------


@query
def join_reviews_listings(frames: Frames) -> DataFrame:
    joined = facts.join_reviews_listings(frames.rated, frames.listings)
    return joined.withColumn("rating", F.round("rating", 10))


@query
def left_join_calendar(frames: Frames) -> DataFrame:
    return facts.review_states(frames.rated, frames.listings, frames.calendar)


def _fact_columns() -> list[Column]:
    return [
        F.col("id"),
        F.col("neighbourhood"),
        F.col("date"),
        F.col("host_id"),
        F.col("room_type"),
        F.col("available_listings_count"),
        F.col("not_available_listings_count"),
        _rounded("prices_sum", 2),
        _rounded("ratings_sum"),
        F.col("declared_reviews_count"),
    ]


@query
def fact_reviews(frames: Frames) -> DataFrame:
    return frames.facts.select(*_fact_columns())


@query
def star_joined(frames: Frames) -> DataFrame:
    joined = star_join(frames.star).drop("id")
    return joined.withColumn("prices_sum", F.round("prices_sum", 2)).withColumn(
        "ratings_sum", F.round("ratings_sum", 4)
    )


# --- analyses -----------------------------------------------------------------------------------


@query
def reviews_by_year_pivot(frames: Frames) -> DataFrame:
    return analyses.reviews_by_year(frames.star)


@query
def reviews_by_year_city(frames: Frames) -> DataFrame:
    return analyses.reviews_by_year(frames.star, CITY)


@query
def reviews_by_year_discovered(frames: Frames) -> DataFrame:
    """The cells of the pivot over all room types in the data, as rows."""
    table = analyses.reviews_by_year(frames.star)
    cells = table.unpivot(["city", "year"], table.columns[2:], "room_type", "reviews")
    return cells.where("reviews IS NOT NULL")


@query
def avg_price_by_month_pivot(frames: Frames) -> DataFrame:
    prices = analyses.avg_price_by_month(frames.star, months=MONTHS)
    return prices.select("city", "month", *[_rounded(name, 6) for name in prices.columns[2:]])


@query
def avg_price_by_month_city(frames: Frames) -> DataFrame:
    prices = analyses.avg_price_by_month(frames.star, CITY, MONTHS)
    return prices.select("month", *[_rounded(name, 6) for name in prices.columns[1:]])


@query
def host_ratings(frames: Frames) -> DataFrame:
    return analyses.host_ratings(frames.star)


@query
def latest_year_hosts(frames: Frames) -> DataFrame:
    return analyses.latest_year_hosts(frames.star, min_reviews=MIN_REVIEWS)


@query
def top_hosts_per_group(frames: Frames) -> DataFrame:
    return analyses.top_hosts(frames.star, min_reviews=MIN_REVIEWS)


@query
def top_hosts_city(frames: Frames) -> DataFrame:
    return analyses.top_hosts(frames.star, CITY, min_reviews=MIN_REVIEWS)


@query
def top_hosts_sql(frames: Frames) -> DataFrame:
    return analyses.top_hosts_sql(frames.spark, frames.star, CITY, min_reviews=MIN_REVIEWS)


@query
def top_hosts_sql_all(frames: Frames) -> DataFrame:
    return analyses.top_hosts_sql(frames.spark, frames.star, min_reviews=MIN_REVIEWS)


# --- warehouse ----------------------------------------------------------------------------------


@query
def warehouse_roundtrip(frames: Frames) -> DataFrame:
    """Fact rows inserted by position, replaced by a second insert, and read back."""
    database = new_database(frames.spark)
    rows = stage(frames.facts, "facts")
    for _ in range(2):
        warehouse.insert_rows(rows, "tof_reviews", database)
    return Star.from_catalog(frames.spark, database).fact.select(*_fact_columns())


@query
def warehouse_append(frames: Frames) -> DataFrame:
    """The same rows appended twice are there twice."""
    database = new_database(frames.spark)
    for _ in range(2):
        rows = dimensions.dim_neighbourhood(frames.listings)
        warehouse.insert_rows(rows, "dim_neighbourhood", database, overwrite=False)
    return Star.from_catalog(frames.spark, database).neighbourhood


def _star_rows(spark: SparkSession, database: str) -> DataFrame:
    joined = star_join(Star.from_catalog(spark, database)).drop("id")
    return joined.withColumn("prices_sum", F.round("prices_sum", 2)).withColumn(
        "ratings_sum", F.round("ratings_sum", 4)
    )


@query
def warehouse_full_load(frames: Frames) -> DataFrame:
    """Raw files, full load into tables partitioned by year, then the star join."""
    spark = frames.spark
    listing_paths = _write_listings(frames)
    positive_words, negative_words = _write_lexicon(frames)
    inputs = warehouse.Inputs(
        read_listings(spark, listing_paths),
        read_calendar(spark, _write_calendar(frames)),
        read_reviews(spark, _write_reviews(frames)),
        read_lexicon(spark, positive_words, negative_words),
    )
    database = new_database(spark, fact_by_year=True)
    warehouse.load_warehouse(spark, inputs, database)
    return _star_rows(spark, database)


@query
def warehouse_merge_load(frames: Frames) -> DataFrame:
    """Reviews in two loads, the second merged with the first: the same tables as by one load."""
    spark = frames.spark
    listings = read_listings(spark, _write_listings(frames))
    calendar = read_calendar(spark, _write_calendar(frames))
    database = new_database(spark, fact_by_year=True)
    odd = F.col("review_id") % 2 == 1
    for records in (frames.review_records.where(odd), frames.review_records.where(~odd)):
        reviews = read_reviews(spark, _write_reviews(frames, records))
        inputs = warehouse.Inputs(listings, calendar, reviews, frames.lexicon)
        warehouse.load_warehouse(spark, inputs, database, merge=True)
    return _star_rows(spark, database)


@query
def warehouse_rejects(frames: Frames) -> DataFrame:
    """A lenient load of faulty files: rows it counted, and the rows it listed by reason."""
    spark = frames.spark
    holes = F.when(F.col("room_type") != "BUILDING", F.col("price"))
    lenient = {"on_error": "null", "rejects": True}
    inputs = warehouse.Inputs(
        read_listings(
            spark, _write_listings(frames, frames.listings.withColumn("price", holes)), **lenient
        ),
        read_calendar(spark, _write_calendar(frames, _unpadded(frames)), **lenient),
        read_reviews(spark, _write_reviews(frames, frames.faulty_records), **lenient),
        frames.lexicon,
    )
    database = new_database(spark, fact_by_year=True)
    counts = warehouse.load_warehouse(spark, inputs, database)
    listed = spark.table(f"{database}.{warehouse.REJECT_TABLE}")
    reasons = listed.select("source", F.explode("reasons").alias("reason"), "kept")
    by_reason = reasons.groupBy("source", "reason", "kept").agg(F.count(F.lit(1)).alias("listed"))

    def counted(name: str) -> Column:
        pairs = [(F.lit(source), F.lit(getattr(c, name))) for source, c in counts.items()]
        numbers = F.create_map(*[part for pair in pairs for part in pair])
        return F.element_at(numbers, F.col("source")).cast("long").alias(f"counted_{name}")

    return by_reason.select("*", *[counted(n) for n in ("rows", "rejected", "left_out")])


@query
def warehouse_run_ids(frames: Frames) -> DataFrame:
    """Facts numbered by run and appended twice: their number and that of their ids."""
    database = new_database(frames.spark, fact_by_year=True)
    days = (
        stage(facts.review_days(frames.rated), "review-days"),
        stage(facts.calendar_days(frames.calendar), "calendar-days"),
    )
    groups = facts.listing_groups(frames.listings)
    for _ in range(2):
        first = warehouse.next_run_id(frames.spark, database)
        rows = facts.fact_from_days(*days, groups, row_id="run", first_id=first)
        warehouse.insert_rows(rows, "tof_reviews", database, overwrite=False)
    table = Star.from_catalog(frames.spark, database).fact
    return table.agg(
        F.count(F.lit(1)).alias("facts"), F.count_distinct("id").alias("ids")
    )


@query
def warehouse_by_city(frames: Frames) -> DataFrame:
    """District names that all cities have, loaded with the city as part of the key."""
    spark = frames.spark
    district = F.concat(F.lit("District "), (F.col("id") % 4).cast("string"))
    listings = frames.listings.withColumns(
        {"neighbourhood": district, "neighbourhood_group": F.concat_ws("/", "city", district)}
    )
    database = new_database(spark, fact_by_year=True, fact_by_city=True)
    groups = facts.listing_groups(listings, by_city=True)
    days = (facts.review_days(frames.rated), facts.calendar_days(frames.calendar))
    tables = {
        "dim_neighbourhood": dimensions.dim_neighbourhood(listings, by_city=True),
        "dim_date": frames.dates,
        "tof_reviews": facts.fact_from_days(*days, groups),
    }
    for name, rows in tables.items():
        warehouse.insert_rows(rows, name, database)
    star = Star.from_catalog(spark, database)
    joined = join_date(join_neighbourhood(star.fact, star), star)
    return joined.groupBy("city", "neighbourhood", "group", "year").agg(
        F.sum(review_count()).alias("reviews"),
        F.round(F.sum("prices_sum"), 2).alias("prices"),
    )
