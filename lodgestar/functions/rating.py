"""Expressions of the lexicon rating."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters deleted from a comment before it is split into words.
DELETED_CHARACTERS = '[".?!,]'

# The rating of a comment without hits, and the scale of the others (0 to 5).
NEUTRAL_RATING = 2.5
HALF_SCALE = 2.5


def words(comment: Column) -> Column:
    """Lower-case words, split at single spaces only; newlines, tabs and hyphens do not split.

    Trailing spaces make no empty words.
    """
    cleaned = F.regexp_replace(comment, DELETED_CHARACTERS, "")
    return F.split(F.lower(F.rtrim(cleaned)), " ")


def rating(positive: Column, negative: Column) -> Column:
    """Share of positive minus share of negative hits, moved to the range 0 to 5."""
    hits = positive + negative
    return F.when(hits == 0, F.lit(NEUTRAL_RATING)).otherwise(
        ((positive - negative) / hits + 1) * HALF_SCALE
    )
