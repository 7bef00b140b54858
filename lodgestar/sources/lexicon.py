"""Word lists: one word per line, any number of files per polarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lexicon_from_words(
    positive_words: DataFrame, negative_words: DataFrame, *, normalize: bool = False
) -> DataFrame:
    """One row per word with 0/1 columns ``positive`` and ``negative``; both may be 1.

    The word is the first column of each input. Entries are taken as they are: comments are
    lower-cased and entries are not, so an entry with a capital letter never matches.
    ``normalize`` lower-cases the entries too.
    """

    def tagged(words: DataFrame, positive: int) -> DataFrame:
        word = F.col(words.columns[0])
        return words.select(
            (F.lower(word) if normalize else word).alias("word"),
            F.lit(positive).alias("positive"),
            F.lit(1 - positive).alias("negative"),
        )

    both = tagged(positive_words, 1).unionByName(tagged(negative_words, 0))
    return (
        both.where(F.col("word").isNotNull())
        .groupBy("word")
        .agg(F.max("positive").alias("positive"), F.max("negative").alias("negative"))
    )


def read_lexicon(
    spark: SparkSession,
    positive_paths: str | list[str],
    negative_paths: str | list[str],
    *,
    normalize: bool = False,
) -> DataFrame:
    """Union of the word lists of all languages, each word once."""
    return lexicon_from_words(
        spark.read.text(positive_paths), spark.read.text(negative_paths), normalize=normalize
    )
