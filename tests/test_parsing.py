import datetime

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodgestar.functions import parsing
from lodgestar.sources import parse_reviews

day = datetime.date


def strings(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def test_money(spark):
    frame = strings(spark, "$1,234.50", None, "80")
    parsed = frame.select("value", parsing.money(F.col("value")).alias("price"))
    assert dict(parsed.collect()) == {"$1,234.50": 1234.5, None: None, "80": 80.0}


def test_bad_money_fails_or_becomes_null(spark):
    frame = strings(spark, "about 5")
    with pytest.raises(PySparkException):
        frame.select(parsing.money(F.col("value"))).collect()
    assert frame.select(parsing.money(F.col("value"), "null")).collect()[0][0] is None


def test_flag_is_true_for_t_only(spark):
    frame = strings(spark, "t", "f", "T", None)
    parsed = frame.select("value", parsing.flag(F.col("value")))
    assert dict(parsed.collect()) == {"t": True, "f": False, "T": False, None: False}


def test_date_is_strict(spark):
    good = strings(spark, "2018-01-02").select(parsing.iso_date(F.col("value")))
    assert good.collect()[0][0] == day(2018, 1, 2)
    for text in ("2018-1-2", "2018-02-30", "02.01.2018", "2018-01-2 ", "2018-01-02\n", " ", None):
        bad = strings(spark, text)
        with pytest.raises(PySparkException):
            bad.select(parsing.iso_date(F.col("value"))).collect()
        assert bad.select(parsing.iso_date(F.col("value"), "null")).collect()[0][0] is None


def test_date_parts(spark):
    frame = spark.createDataFrame([(day(2018, 3, 9),)], "date date")
    assert tuple(frame.select(*parsing.date_parts(F.col("date"))).collect()[0]) == (9, 3, 2018)


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        parsing.money(F.col("value"), "ignore")


REVIEW_CASES = [
    (
        "Review 11 for listing 22 by bob on 2018-01-02:Great place",
        [(22, day(2018, 1, 2), "Great place")],
    ),
    (
        'Review 12 for listing 23 posted 2018-01-03:"line one\nline two, nice"',
        [(23, day(2018, 1, 3), '"line one\nline two, nice"')],
    ),
    ('Review 13 for listing 24 x 2018-01-04:""', []),
    (
        "Review 14 for listing 25 x 2017-01-01: mid 2018-01-05:last date wins",
        [(25, day(2018, 1, 5), "last date wins")],
    ),
    ("Review 15 for listing 26 x 2018-01-06:", []),
    (
        'Review 16 for listing 27 x 2018-01-07:"say ""hi"" you"',
        [(27, day(2018, 1, 7), '"say "')],
    ),
    (
        "Review 17 for listing 28 x 2018-01-08:with carriage return\r\n",
        [(28, day(2018, 1, 8), "with carriage return")],
    ),
    ("Rating 18 for listing 29 x 2018-01-09:any six", [(29, day(2018, 1, 9), "any six")]),
    (
        "Review 19 for listing 3000000000 x 2018-01-10:wide id",
        [(3000000000, day(2018, 1, 10), "wide id")],
    ),
    (
        "Review 20 for listing 31 x 2018-01-11:one\x1ftwo\x1fthree $1 \\1",
        [(31, day(2018, 1, 11), "one\x1ftwo\x1fthree $1 \\1")],
    ),
    ("no record here", []),
]


@pytest.mark.parametrize("text, expected", REVIEW_CASES)
def test_review_extraction(spark, text, expected):
    found = parse_reviews(strings(spark, text)).select("listing_id", "date", "comment")
    assert [tuple(row) for row in found.collect()] == expected


def test_all_records_of_one_text(spark):
    text = "\n".join(case for case, _ in REVIEW_CASES)
    expected = [record for _, records in REVIEW_CASES for record in records]
    found = parse_reviews(strings(spark, text))
    assert [tuple(r) for r in found.select("listing_id", "date", "comment").collect()] == expected
    assert found.select("review_id").distinct().count() == len(expected)


def test_unpadded_review_date_fails_or_becomes_null(spark):
    frame = strings(spark, "Review 11 for listing 22 x 2018-1-2:text")
    with pytest.raises(PySparkException):
        parse_reviews(frame).collect()
    assert rows(parse_reviews(frame, on_error="null"), "listing_id", "date") == [(22, None)]
