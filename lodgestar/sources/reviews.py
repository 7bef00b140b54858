"""Guest reviews: free text holding records of the form given by the review pattern."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgestar.functions import parsing
from lodgestar.sources.blocks import read_blocks, with_heads
from lodgestar.sources.rejects import reason, reject
from lodgestar.sources.splits import spread


def _pieces(
    spark: SparkSession, paths: str | list[str], mode: str, prefix: str, placed: bool = False
) -> DataFrame:
    """Text pieces to search for records, column ``value``; ``placed`` adds file, block and row.

    ``split``: the reader cuts the files at line starts with ``prefix``, so one large file is read
    by many tasks, once, and no text is shuffled. Records that start otherwise are found within the
    pieces; ``prefix`` only decides where a file may be cut. A quoted comment that itself has such a
    line would be cut; its piece then has an unclosed quote, which fails the job instead of giving
    other records than a search of the whole file would. The first piece of a file had no separator
    before it and stays as it is; the task that reads it sees that it is the first.

    ``whole``: each file is one piece, exact for any text, at most 2 GB per file.
    """
    if mode == "whole":
        whole = spark.read.text(paths, wholetext=True)
        place = [
            F.col("_metadata.file_path").alias("file"),
            F.lit(0).cast("long").alias("block"),
            F.lit(0).cast("long").alias("row"),
        ]
        return whole.select("value", *place) if placed else whole
    if mode != "split":
        raise ValueError(f"mode must be 'split' or 'whole', not {mode!r}")
    pieces = with_heads(read_blocks(spark, paths, f"\n{prefix}"), placed=placed)
    place = ["file", "block", "row"] if placed else []
    value = F.when(F.col("head"), F.col("value")).otherwise(
        F.concat(F.lit(prefix), F.col("value"))
    )
    error = F.raise_error(
        F.concat(
            F.lit("comment not closed, read this input with mode='whole': "),
            F.substring("value", 1, 80),
        )
    )
    checked = F.when(parsing.has_open_comment(F.col("value")), error).otherwise(F.col("value"))
    return pieces.select(value.alias("value"), *place).select(checked.alias("value"), *place)


def _records(pieces: DataFrame) -> DataFrame:
    """Records as ``field``; where the pieces have a place also that, and ``match``, the record itself."""
    place = [name for name in pieces.columns if name != "value"]
    # Most pieces are one record, which is found without the pattern's way through all its text.
    # One step at a time, so that nothing is computed twice.
    value, single = F.col("value"), F.col("single")
    cut = pieces.select("value", *place, *parsing.head_and_rest(value))
    cut = cut.select(
        "value", *place, "head", parsing.leading_comment(F.col("rest")).alias("comment")
    )
    joined = parsing.single_record(F.col("head"), F.col("comment")).alias("single")
    # Outer, as Spark would else look for the records twice, first to tell whether there are any.
    if not place:
        found = F.when(single.isNotNull(), F.array(F.lit(""), single)).otherwise(
            parsing.review_records(value)
        )
        parts = cut.select("value", joined).select(F.posexplode_outer(found))
        return parts.where("pos % 2 = 1").select(parsing.split_fields(F.col("col")).alias("field"))
    told = cut.select("value", *place, "head", "comment", joined)
    found = F.when(single.isNotNull(), F.array(parsing.whole_record(single))).otherwise(
        parsing.matched_records(value)
    )
    parts = told.select(*place, "head", "comment", F.explode_outer(found).alias("record"))
    # A single record is the head and the comment that it was cut into.
    match = F.coalesce(F.col("record.match"), F.concat("head", F.lit(":"), "comment"))
    return parts.where("record IS NOT NULL").select(
        *place, match.alias("match"), parsing.split_fields(F.col("record.joined")).alias("field")
    )


def parse_reviews(pieces: DataFrame, *, on_error: str = "fail") -> DataFrame:
    """Reviews found in the ``value`` column: review_id, listing_id, date, comment.

    ``review_id`` tells equal reviews apart. Behind ``read_reviews`` it is made in the task that
    scans the text, from the position of the row, so a task that runs again gives the same ids.
    Where the pieces have a place (file, block, row) the column ``reject`` is added.
    """
    records = _records(pieces)
    listing_id = parsing.cast(F.col("field")[0], "long", on_error)
    date = parsing.iso_date(F.col("field")[1], on_error)
    told = []
    if "file" in records.columns:
        parsing.check_lenient(on_error)
        faults = [
            reason("listing_id", F.col("field")[0], listing_id),
            reason("date", F.col("field")[1], date),
        ]
        told = [reject("reviews", faults, F.col("match"), F.lit(False))]
    return records.select(
        F.monotonically_increasing_id().alias("review_id"),
        listing_id.alias("listing_id"),
        date.alias("date"),
        F.col("field")[2].alias("comment"),
        *told,
    )


def read_reviews(
    spark: SparkSession,
    paths: str | list[str],
    *,
    mode: str = "split",
    on_error: str = "fail",
    partitions: int | None = None,
    prefix: str = parsing.REVIEW_PREFIX,
    rejects: bool = False,
) -> DataFrame:
    """Reviews of all inputs in one scan; see ``_pieces`` for the two ways to cut the text.

    ``prefix`` is what most records start with, at the start of a line. ``partitions`` moves the
    reviews to so many tasks, for few large files read as a whole. ``rejects`` (with
    ``on_error="null"``) adds the column ``reject``; reviews without listing or date do not count.
    """
    pieces = _pieces(spark, paths, mode, prefix, rejects)
    return spread(parse_reviews(pieces, on_error=on_error), partitions, "review_id")


def rejected_review_rows(
    spark: SparkSession,
    paths: str | list[str],
    *,
    mode: str = "split",
    prefix: str = parsing.REVIEW_PREFIX,
) -> DataFrame:
    """Records that match the pattern but hold no valid listing id or date (raw strings)."""
    records = _records(_pieces(spark, paths, mode, prefix)).select(
        F.col("field")[0].alias("listing_id"),
        F.col("field")[1].alias("date"),
        F.col("field")[2].alias("comment"),
    )
    return records.where(
        F.col("listing_id").try_cast("long").isNull()
        | parsing.iso_date(F.col("date"), "null").isNull()
    )
