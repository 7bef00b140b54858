"""Listings, reviews, calendar and lexicon frames made from the given tables.

Customers are listings, orders are stays with a review, documents are the review texts, order lines
are calendar rows, and the words of the benchmark texts are the lexicon. All rows of the tables are
used.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgestar.functions.rating import words
from lodgestar.operators import dimensions, facts
from lodgestar.operators.sentiment import rate_texts
from lodgestar.operators.star import Star
from lodgestar.plans.warehouse import create_warehouse, insert_rows
from lodgestar.session import scratch_path, stage
from lodgestar.sources import lexicon_from_words

# What ends a line for the review pattern.
LINE_BREAKS = "\n\r\x85\u2028\u2029"

# Order lines that a task joins with their orders and sums per listing and day.
LINES_PER_TASK = 500_000

# Application and folder of tables -> database with their warehouse.
_warehouses: dict[tuple[str, str], str] = {}


def new_database(spark: SparkSession, **options) -> str:
    """An empty warehouse below the shared folder."""
    location = scratch_path(spark, "warehouse")
    database = "lodgestar_" + location.rsplit("-", 1)[1]
    create_warehouse(spark, database, location=location, **options)
    return database


@dataclass
class Frames:
    spark: SparkSession
    folder: str
    _tables: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def listings(self) -> DataFrame:
        rows = (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return rows.selectExpr(
            "c_custkey AS id",
            # Commas, doubled quotes and a newline, as in real listing titles.
            """concat('Flat "', c_name, '",\\nfloor ', c_nationkey) AS name""",
            "c_custkey div 5 AS host_id",
            "concat('Host#', c_custkey div 5) AS host_name",
            "concat_ws('-', r_name, n_nationkey % 2) AS neighbourhood_group",
            "n_name AS neighbourhood",
            "c_nationkey * 1.5D AS latitude",
            "c_nationkey * -2.5D AS longitude",
            "c_mktsegment AS room_type",
            "int(round(abs(c_acctbal))) AS price",
            "int(c_custkey % 3 + 1) AS minimum_nights",
            "int(c_custkey % 7 + 1) AS number_of_reviews",
            "CASE WHEN c_custkey % 4 > 0 THEN '1998-08-02' END AS last_review",
            "CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 8 / 4 END AS reviews_per_month",
            "5 AS calculated_host_listings_count",
            "int(c_custkey % 366) AS availability_365",
            "r_name AS city",
        )

    @cached_property
    def cities(self) -> list[str]:
        """Cities of the listings, one input path each."""
        return sorted(row[0] for row in self.listings.select("city").distinct().collect())

    @cached_property
    def lexicon(self) -> DataFrame:
        """Benchmark words of more than 3 characters: even length positive, else negative.

        Staged, so that its measured size and not that of the texts decides whether it is broadcast.
        """
        positive, negative = self.lexicon_words
        return stage(lexicon_from_words(positive, negative), "lexicon")

    @cached_property
    def large_lexicon(self) -> DataFrame:
        """Words of the conversations, which grow with them, by the same rule."""
        tokens = self.table("conversations").select(F.explode(words(F.col("text"))).alias("word"))
        length = F.length("word")
        used = tokens.where(length > 3)
        return stage(
            lexicon_from_words(used.where(length % 2 == 0), used.where(length % 2 == 1)),
            "large-lexicon",
        )

    @property
    def lexicon_words(self) -> tuple[DataFrame, DataFrame]:
        # A word list has a word per line, so no word may hold a newline.
        lines = F.translate("text", "\n", " ")
        tokens = self.table("benchmark").select(F.explode(words(lines)).alias("word"))
        length = F.length("word")
        used = tokens.where(length > 3)
        return used.where(length % 2 == 0), used.where(length % 2 == 1)

    @cached_property
    def rated_documents(self) -> DataFrame:
        documents = self.table("documents").select("doc_id", "text").repartition("doc_id")
        return rate_texts(documents, self.lexicon, key="doc_id", text="text")

    @cached_property
    def stays(self) -> DataFrame:
        """Orders with the document that is their review text; the documents are used in turn."""
        documents = self.table("documents")
        number = documents.agg(F.max("doc_id") + 1).scalar()
        return self.table("orders").select(
            F.col("o_orderkey").alias("review_id"),
            F.col("o_custkey").alias("listing_id"),
            F.to_date("o_orderdate").alias("date"),
            (F.col("o_orderkey") % number).alias("doc_id"),
        )

    @cached_property
    def rated(self) -> DataFrame:
        """Rated reviews, one per order; each text is rated once, before the join."""
        ratings = self.rated_documents.select("doc_id", "rating")
        return self.stays.join(ratings, "doc_id").select(
            "review_id", "listing_id", "date", "rating"
        )

    @cached_property
    def calendar(self) -> DataFrame:
        """One row per order line, so most stays meet several; some orders have no line.

        The lines are dealt to a number of tasks that grows with them and that Spark does not reduce,
        so what a task sorts and sums does not grow.
        """
        lines = self.table("lineitem")
        tasks = max(
            int(self.spark.conf.get("spark.sql.shuffle.partitions")),
            lines.count() // LINES_PER_TASK,
        )
        lines = lines.repartition(tasks, "l_orderkey")
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
            "o_custkey AS listing_id",
            "date(o_orderdate) AS date",
            "l_linestatus = 'O' AS available",
            "CASE WHEN l_returnflag != 'R' THEN l_extendedprice END AS price",
        )

    @cached_property
    def facts(self) -> DataFrame:
        return facts.fact_reviews(self.rated, self.listings, self.calendar)

    @cached_property
    def dates(self) -> DataFrame:
        return dimensions.dim_date(self.calendar, self.stays)

    @property
    def star(self) -> Star:
        """The warehouse tables of these frames, loaded at their first use in an application.

        The analyses read tables, as they do in practice: Spark then knows the size of each
        dimension when it plans a join, and the facts are computed once for all of them.
        """
        key = (self.spark.sparkContext.applicationId, self.folder)
        if key not in _warehouses:
            _warehouses[key] = self._load_warehouse()
        return Star.from_catalog(self.spark, _warehouses[key])

    def _load_warehouse(self) -> str:
        database = new_database(self.spark, fact_by_year=True)
        tables = {
            "dim_room_type": dimensions.dim_room_type(self.listings),
            "dim_neighbourhood": dimensions.dim_neighbourhood(self.listings),
            "dim_date": self.dates,
            "dim_host": dimensions.dim_host(self.listings),
        }
        for name, rows in tables.items():
            insert_rows(rows, name, database)
        insert_rows(self.facts, "tof_reviews", database, stable_ids=True)
        return database

    def _records(self, plain: Column, quoted: Column, bad_dates: Column | None = None) -> DataFrame:
        """One text record per order with the document of its stay: quoted and plain in turn.

        Where ``bad_dates`` holds, the date has a digit too many. Both forms are made once per
        document, before the join. Its size tells little of the joined text, which is many times as
        much, so the documents are dealt to a number of tasks that Spark does not reduce. They are
        sorted, as few stays would else be broadcast and the forms made once per stay.
        """
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        forms = {"doc_id": F.col("doc_id"), "quoted": quoted, "plain": plain}
        documents = self.table("documents").repartition(tasks, "doc_id")
        documents = documents.select(*[form.alias(name) for name, form in forms.items()])
        comment = F.when(
            F.col("review_id") % 2 == 0, F.concat(F.lit('"'), F.col("quoted"), F.lit('"'))
        ).otherwise(F.col("plain"))
        record = F.concat(
            F.lit("Review "),
            "review_id",
            F.lit(" for listing "),
            "listing_id",
            F.lit(" by a guest on "),
            F.date_format("date", "yyyy-MM-dd"),
            F.when(F.lit(False) if bad_dates is None else bad_dates, "0").otherwise(""),
            F.lit(":"),
            comment,
        )
        joined = self.stays.join(documents.hint("merge"), "doc_id")
        return joined.select("review_id", record.alias("value"))

    def _whole_documents(self, bad_dates: Column | None = None) -> DataFrame:
        quoted = F.replace("text", F.lit('"'), F.lit("'"))
        plain = F.translate(quoted, LINE_BREAKS, " " * len(LINE_BREAKS))
        return self._records(plain, quoted, bad_dates)

    @cached_property
    def review_records(self) -> DataFrame:
        """Records whose comments are whole documents.

        As in a dump, a comment holds no quotes, and one that is not quoted no line breaks.
        """
        return self._whole_documents()

    @cached_property
    def faulty_records(self) -> DataFrame:
        """The same, but a tenth of them has no valid date."""
        return self._whole_documents(F.col("review_id") % 10 == 3)

    @cached_property
    def awkward_records(self) -> DataFrame:
        """Records with the documents as they are, so that the pattern cuts many of them."""
        return self._records(F.col("text"), F.col("text"))
