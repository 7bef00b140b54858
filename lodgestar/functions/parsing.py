"""Expressions that turn raw text fields into typed values.

``on_error="fail"`` makes a malformed value fail the job (ANSI mode), ``"null"`` turns it into null;
`lodgestar.sources` can list the affected raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the record format of a review dump. Groups: listing id, date, comment.
REVIEW_PATTERN = r'.{6} \d+ for listing (\d+) .+(\d{4}-\d+-\d+):((?!")(.+)|"[^"]+")'

# Fixed value: the text each review record starts with.
REVIEW_PREFIX = "Review "

# What a record has up to its first colon, if its date ends there, and its comment behind that colon.
_HEAD = r"\A.{6} \d+ for listing (\d+) .+(\d{4}-\d+-\d+)\z"
_COMMENT = r'\A(?:(?!").+|"[^"]+")'

# A record whose quoted comment has no closing quote in the same piece of text.
_OPEN_COMMENT = r'.{6} \d+ for listing \d+ .+\d{4}-\d+-\d+:"[^"]*\z'

_ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_UNIT_SEPARATOR = "\x1f"
_RECORD_SEPARATOR = "\x1e"


def _check_mode(on_error: str) -> None:
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")


def check_lenient(on_error: str) -> None:
    """Rows are only rejected where a malformed value does not fail the job."""
    if on_error != "null":
        raise ValueError("rejected rows are told with on_error='null' only")


def cast(value: Column, data_type, on_error: str = "fail") -> Column:
    _check_mode(on_error)
    return value.cast(data_type) if on_error == "fail" else value.try_cast(data_type)


def required(value: Column, what: str) -> Column:
    """The value; null fails the job."""
    return F.coalesce(value, F.raise_error(F.lit(f"{what} is missing")))


def iso_date(value: Column, on_error: str = "fail") -> Column:
    """Strict ``yyyy-MM-dd``: ``2018-1-2``, which a cast takes, is an error.

    A shape test and a cast take less than half the time of parsing with a format.
    """
    _check_mode(on_error)
    if on_error == "null":
        return F.when(value.rlike(_ISO_DATE), value.try_cast("date"))
    error = F.raise_error(F.concat(F.lit("not a date: "), F.coalesce(value, F.lit("null"))))
    return F.when(value.rlike(_ISO_DATE), value.cast("date")).otherwise(error)


def money(value: Column, on_error: str = "fail") -> Column:
    """``$1,234.50`` -> 1234.5; null stays null."""
    empty = F.lit("")
    digits = F.replace(F.replace(value, F.lit("$"), empty), F.lit(","), empty)
    return cast(digits, "double", on_error)


def flag(value: Column) -> Column:
    """True for exactly ``t``; false for anything else, null included."""
    return value.eqNullSafe(F.lit("t"))


def date_parts(date: Column) -> list[Column]:
    return [
        F.day(date).alias("day"),
        F.month(date).alias("month"),
        F.year(date).alias("year"),
    ]


def review_matches(text: Column) -> Column:
    """All review records found in a piece of text, as an array of the matched strings."""
    return F.regexp_extract_all(text, F.lit(REVIEW_PATTERN), F.lit(0))


def review_fields(match: Column) -> Column:
    """``[listing id, date, comment]`` of one matched record, all strings, in one regex pass.

    The comment comes last and the split is limited to three parts, so a separator character
    inside the comment stays in the comment.
    """
    return split_fields(_joined_fields(match))


def _joined_fields(match: Column) -> Column:
    return F.regexp_replace(
        match, REVIEW_PATTERN, f"$1{_UNIT_SEPARATOR}$2{_UNIT_SEPARATOR}$3"
    )


def split_fields(joined: Column) -> Column:
    return F.split(joined, _UNIT_SEPARATOR, 3)


def review_records(text: Column) -> Column:
    """What lies between the records of a text, and the records, in turn: the latter at odd places.

    A record is its fields joined as in ``review_fields``, which ``split_fields`` takes apart. One
    regex pass finds records and fields; a text with the separator in it takes two.
    """
    fields = f"$1{_UNIT_SEPARATOR}$2{_UNIT_SEPARATOR}$3"
    marked = F.regexp_replace(
        text, REVIEW_PATTERN, f"{_RECORD_SEPARATOR}{fields}{_RECORD_SEPARATOR}"
    )
    one_by_one = F.transform(
        review_matches(text), lambda match: F.array(F.lit(""), _joined_fields(match))
    )
    return F.when(text.contains(_RECORD_SEPARATOR), F.flatten(one_by_one)).otherwise(
        F.split(marked, _RECORD_SEPARATOR, -1)
    )


def matched_records(text: Column) -> Column:
    """All records of a text as an array: ``joined`` as in ``review_fields``, and ``match``, as it stands."""
    return F.transform(
        review_matches(text),
        lambda match: F.struct(_joined_fields(match).alias("joined"), match.alias("match")),
    )


def whole_record(joined: Column) -> Column:
    """A record as in ``matched_records`` whose text is known."""
    return F.struct(joined.alias("joined"), F.lit(None).cast("string").alias("match"))


def head_and_rest(text: Column) -> list[Column]:
    """Columns ``head`` and ``rest``: what lies before and behind the first colon of a text."""
    head = F.substring_index(text, ":", 1)
    return [head.alias("head"), F.substr(text, F.length(head) + F.lit(2)).alias("rest")]


def leading_comment(rest: Column) -> Column:
    """The comment that a text starts with, if no date can end in it or behind it; else empty.

    A search for a digit and a colon takes much less time than one for a date.
    """
    ends = F.lit(False)
    for digit in "0123456789":
        ends = ends | rest.contains(f"{digit}:")
    dated = rest.contains(":") & ends
    return F.when(dated, "").otherwise(F.regexp_extract(rest, _COMMENT, 0))


def single_record(head: Column, comment: Column) -> Column:
    """The record, as in ``review_records``, of a text that starts with it and has no other; else null.

    The pattern looks for the last date of a line, from its end. Where no date ends behind the first
    colon the only record there may be has its date before that colon, so the pattern is tried on
    the few characters before it. Null says nothing of the text: it is left to the pattern.
    """
    fields = F.regexp_replace(head, _HEAD, f"$1{_UNIT_SEPARATOR}$2{_UNIT_SEPARATOR}")
    return F.when((comment != "") & head.rlike(_HEAD), F.concat(fields, comment))


def has_open_comment(text: Column) -> Column:
    """True where a quoted comment starts and is not closed before the text ends.

    The last quote of the text is then the one that opens the comment, right after a colon; texts of
    another end are told from it without the pattern.
    """
    opens = F.concat(F.lit(':"'), F.substring_index(text, '"', -1))
    return text.contains(':"') & text.endswith(opens) & text.rlike(_OPEN_COMMENT)
