"""Insert into warehouse tables: after the old rows, instead of them, or merged with them by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgestar.operators.facts import FACT_KEYS, fact_keys, stable_id
from lodgestar.schemas import DIMENSION_KEYS, WAREHOUSE_TABLES
from lodgestar.staging import Staging, settings

_SUMS = [name for name, _ in WAREHOUSE_TABLES["tof_reviews"] if name not in (*FACT_KEYS, "id")]


def table_name(database: str | None, name: str) -> str:
    return f"`{database}`.`{name}`" if database else f"`{name}`"


#: Columns in whose order a dimension is written: each file holds a range of them.
WRITTEN_ORDER = {"dim_neighbourhood": ["city"], "dim_date": ["year", "month", "day"]}


def in_written_order(name: str, rows: DataFrame) -> DataFrame:
    """Rows of a dimension ranged and sorted as its files are to be, so that file statistics tell
    which of them a filter needs."""
    order = WRITTEN_ORDER.get(name)
    return rows.orderBy(*order) if order else rows


def insert_rows(
    rows: DataFrame,
    name: str,
    database: str | None = None,
    *,
    overwrite: bool = True,
    stable_ids: bool = False,
) -> None:
    """Insert by position, replacing the old rows or (``overwrite=False``) after them.

    Appending the same load twice doubles the table, so replacing is the default. ``stable_ids`` tells
    that the ids are those of ``stable_id``: they are then made behind the shuffle that deals facts by
    year, of which they would be more than half.
    """
    table = table_name(database, name)
    columns = rows.sparkSession.table(table).columns
    if _by_year(name, columns):
        # Evenly sized files per year; a year too large for one task is split over several.
        rows = rows.withColumn("year", F.year("date"))
        if stable_ids:
            others = [column for column in rows.columns if column != "id"]
            dealt = rows.select(*others).hint("rebalance", F.col("year"))
            rows = dealt.select(stable_id(*fact_keys(dealt)).alias("id"), *others)
        else:
            rows = rows.hint("rebalance", F.col("year"))
    rows.write.insertInto(table, overwrite=overwrite)


def _by_year(name: str, columns: list[str]) -> bool:
    """Whether the table has a partition column ``year`` besides its own columns."""
    return "year" in set(columns) - {column for column, _ in WAREHOUSE_TABLES.get(name, ())}


def _smallest(rows: DataFrame, name: str) -> DataFrame:
    """One row per key of a dimension, the smallest; nulls only where there is nothing else."""
    key, order = DIMENSION_KEYS[name]
    names = [column for column, _ in WAREHOUSE_TABLES[name]]
    if not order:
        return rows.select(key).distinct()
    if len(order) == 1:
        return rows.groupBy(key).agg(F.min(order[0]).alias(order[0])).select(*names)
    first = rows.groupBy(key).agg(F.min(F.struct(*order)).alias("first"))
    return first.select(*[F.col(c if c == key else f"first.{c}").alias(c) for c in names])


def merge_dimension(
    staging: Staging, rows: DataFrame, name: str, database: str | None = None
) -> None:
    """Adds the keys that the table lacks; of a key that both have the smallest row stays.

    New keys are found by a join and appended. Only where a known key gets a smaller row is the
    table written anew. Null is a key like others.
    """
    spark, (key, order) = rows.sparkSession, DIMENSION_KEYS[name]
    names = [column for column, _ in WAREHOUSE_TABLES[name]]
    new = _smallest(rows.toDF(*names), name)
    old = spark.table(table_name(database, name))
    known = old.select(
        F.col(key).alias("old_key"), F.struct(*order, F.lit(1)).alias("old_row"), F.lit(1).alias("old")
    )
    met = new.join(known, F.col(key).eqNullSafe(F.col("old_key")), "left")
    both = F.struct(*order, F.lit(1))
    smaller = F.col("old").isNotNull() & (both < F.col("old_row"))
    if len(order) == 1:  # a null is no smaller value
        smaller = smaller & F.col(order[0]).isNotNull() | (
            F.col("old").isNotNull()
            & F.col(order[0]).isNotNull()
            & F.col(f"old_row.{order[0]}").isNull()
        )
    marked = met.select(*names, F.col("old").isNull().alias("is_new"), smaller.alias("is_smaller"))
    changes = staging.write(marked.where("is_new OR is_smaller"), f"changes_{name}")
    if changes.where("is_smaller").isEmpty():
        fresh = in_written_order(name, changes.select(*names))
        if not fresh.isEmpty():
            insert_rows(fresh, name, database, overwrite=False)
        return
    merged = _smallest(old.unionByName(changes.select(*names)), name)
    # A table cannot be read while it is replaced.
    merged = staging.write(merged, f"merged_{name}")
    insert_rows(in_written_order(name, merged), name, database)


def merge_facts(
    staging: Staging, rows: DataFrame, name: str = "tof_reviews", database: str | None = None
) -> None:
    """Sums ``rows`` with the facts of equal key.

    Of a table partitioned by year only the years that the new rows touch are read and replaced.
    """
    spark = rows.sparkSession
    table = spark.table(table_name(database, name))
    by_year = _by_year(name, table.columns)
    new = staging.write(rows.withColumn("year", F.year("date")), "new_facts")
    old = table if by_year else table.withColumn("year", F.year("date"))
    if by_year:
        # As many values as a calendar has years.
        years = [row[0] for row in new.select("year").distinct().collect()]
        old = old.where(F.col("year").isin([y for y in years if y is not None]))
    together = old.select(*new.columns).unionByName(new)
    summed = together.groupBy(*FACT_KEYS, "year").agg(*[F.sum(c).alias(c) for c in _SUMS])
    named = [F.col(c) for c, _ in WAREHOUSE_TABLES[name] if c != "id"]
    merged = summed.select(stable_id(*FACT_KEYS).alias("id"), *named, "year")
    merged = staging.write(merged, "merged_facts")
    if not by_year:
        insert_rows(merged.drop("year"), name, database)
        return
    with settings(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        insert_rows(merged.drop("year"), name, database, stable_ids=True)
