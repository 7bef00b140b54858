"""Intermediate tables of one job, bucketed where joins profit, and gone when it ends."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lodgestar.session import scratch_path


class Staging:
    """Tables in a database of their own below the shared folder.

    Written tables cut the lineage and are read by every executor. Leaving the ``with`` block drops
    the database with all files, whether the job ended or failed.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.database = f"lodgestar_staging_{uuid.uuid4().hex}"
        self.location = scratch_path(spark, "staging")

    def __enter__(self) -> Staging:
        self.spark.sql(f"CREATE DATABASE `{self.database}` LOCATION '{self.location}'")
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")

    def write(
        self,
        rows: DataFrame,
        name: str,
        *,
        bucket_by: str | None = None,
        partition_by: Sequence[str] = (),
        compression: str | None = None,
    ) -> DataFrame:
        """``rows`` as a table. ``bucket_by`` deals them by that key, one file per bucket, so that
        aggregations and joins on it shuffle nothing further."""
        writer = rows.write
        if bucket_by:
            buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            writer = rows.repartition(buckets, bucket_by).write
            writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if compression:
            writer = writer.option("compression", compression)
        table = f"`{self.database}`.`{name}`"
        writer.format("parquet").saveAsTable(table)
        return self.spark.table(table)


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the plans made within the block; ``__`` in a name stands for a dot."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
