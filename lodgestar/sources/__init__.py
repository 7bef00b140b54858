"""Readers of the raw files. Each returns a DataFrame; nothing is inferred from the data."""

from lodgestar.sources.calendar import read_calendar, rejected_calendar_rows
from lodgestar.sources.layout import RawLayout
from lodgestar.sources.lexicon import lexicon_from_words, read_lexicon
from lodgestar.sources.listings import (
    check_required,
    read_listings,
    rejected_listing_rows,
    required_field_nulls,
)
from lodgestar.sources.reviews import parse_reviews, read_reviews, rejected_review_rows
from lodgestar.sources.splits import spread

__all__ = [
    "RawLayout",
    "check_required",
    "lexicon_from_words",
    "parse_reviews",
    "read_calendar",
    "read_lexicon",
    "read_listings",
    "read_reviews",
    "rejected_calendar_rows",
    "rejected_listing_rows",
    "rejected_review_rows",
    "required_field_nulls",
    "spread",
]
