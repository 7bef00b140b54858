import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lodgestar.operators.star import Star, ratio_of_sums, room_types, star_join, top_k_per_group
from lodgestar.plans import analyses

FACT = (
    "id string, neighbourhood string, date date, host_id string, room_type string, "
    "available_listings_count long, not_available_listings_count long, prices_sum double, "
    "ratings_sum double, declared_reviews_count long"
)


def date(year, month=1):
    return datetime.date(year, month, 1)


@pytest.fixture(scope="module")
def star(spark):
    def fact(neighbourhood, when, host, room, available, not_available, prices, ratings):
        return ("x", neighbourhood, when, host, room, available, not_available, prices, ratings, 1)

    facts = [
        fact("Alex", date(2017), "1", "A", 2, 1, 30.0, 9.0),
        fact("Alex", date(2018), "1", "A", 40, 0, 400.0, 180.0),
        fact("Alex", date(2018), "2", "A", 30, 5, None, 157.5),
        fact("Alex", date(2018, 6), "3", "A", 50, 0, 100.0, 230.0),
        fact("Alex", date(2018, 6), "4", "A", 31, 0, 31.0, 31.0),
        fact("Alex", date(2018, 6), "5", "A", 30, 0, 30.0, 150.0),
        fact("Wedding", date(2018, 6), "1", "B", 32, 0, 320.0, 32.0),
        fact("Sol", date(2019), "1", "B", 33, 0, None, 33.0),
        fact(None, date(2019), "1", "B", 1, 0, 1.0, 1.0),
        fact("Alex", date(2018), None, "A", 1, 0, 7.0, 1.0),
        fact("Alex", date(2018), "1", None, 1, 0, 7.0, 1.0),
    ]
    dates = [date(2017), date(2018), date(2018, 6), date(2019)]
    return Star(
        fact=spark.createDataFrame(facts, FACT),
        neighbourhood=spark.createDataFrame(
            [("Alex", "Mitte", "BERLIN"), ("Wedding", "Nord", "BERLIN"), ("Sol", "Sol", "MADRID")],
            "name string, group string, city string",
        ),
        date=spark.createDataFrame(
            [(d, d.day, d.month, d.year) for d in dates], "date date, day int, month int, year int"
        ),
        room_type=spark.createDataFrame([("A",), ("B",), (None,)], "room_type string"),
        host=spark.createDataFrame([(str(n), f"Host {n}") for n in range(1, 6)], "id string, name string"),
    )


def test_star_join_drops_rows_without_partner(star):
    assert star_join(star).count() == 8


def test_reviews_by_year(star):
    table = analyses.reviews_by_year(star, "BERLIN")
    assert table.columns == ["year", "A", "B"]
    assert [tuple(r) for r in table.collect()] == [(2017, 3, None), (2018, 187, 32)]
    everywhere = analyses.reviews_by_year(star, values=["B"])
    assert rows(everywhere, "city", "year", "B") == [
        ("BERLIN", 2017, None),
        ("BERLIN", 2018, 32),
        ("MADRID", 2019, 33),
    ]


def test_price_by_month_counts_unknown_prices_in_the_divisor(star):
    table = analyses.avg_price_by_month(star, "BERLIN", months=["1", 6])
    assert rows(table, "month", "A", "B") == [
        (1, (30.0 + 400.0 + 7.0) / 79, None),
        (6, 161.0 / 111, 10.0),
    ]
    assert rows(analyses.avg_price_by_month(star, "MADRID"), "month", "A", "B") == [(1, None, None)]


def test_zero_divisor_is_null(spark):
    frame = spark.createDataFrame([(1.0, 0)], "x double, y int")
    assert frame.agg(ratio_of_sums(F.col("x"), F.col("y"))).collect()[0][0] is None


def test_room_types_come_from_the_dimension(star):
    assert room_types(star) == ["A", "B"]


def test_top_hosts(star):
    best = analyses.top_hosts(star, "BERLIN")
    # Hosts 1 and 2 have rating 4.5; host 2 has fewer reviews. Host 5 has only 30.
    assert [tuple(r) for r in best.collect()] == [
        ("Nord", "Host 1", 1.0, 32),
        ("Mitte", "Host 3", 4.6, 50),
        ("Mitte", "Host 2", 4.5, 35),
    ]


def test_top_hosts_of_all_cities_use_each_city_s_latest_year(star):
    best = analyses.top_hosts(star, k=1)
    assert rows(best) == [
        ("BERLIN", "Mitte", "Host 3", 4.6, 50),
        ("BERLIN", "Nord", "Host 1", 1.0, 32),
        ("MADRID", "Sol", "Host 1", 1.0, 33),
    ]


def test_sql_form_gives_the_same(spark, star):
    in_sql = analyses.top_hosts_sql(spark, star, "BERLIN")
    everywhere = analyses.top_hosts_sql(spark, star, k=1)
    assert in_sql.collect() == analyses.top_hosts(star, "BERLIN").collect()
    assert rows(everywhere) == rows(analyses.top_hosts(star, k=1))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("rated_hosts_")]


def test_unknown_city_gives_no_rows(star):
    assert analyses.top_hosts(star, "ROME").count() == 0
    assert analyses.reviews_by_year(star, "ROME").count() == 0


def test_rating_ties_are_rounded_up(spark, star):
    noisy = star.fact.where("host_id = '1' AND neighbourhood = 'Sol'").withColumn(
        "ratings_sum", F.lit(33 * 4.374999999999999)
    )
    rated = analyses.host_ratings(Star(noisy, star.neighbourhood, star.date, star.room_type, star.host))
    assert rows(rated, "avg_rating") == [(4.38,)]


def test_top_k(spark):
    frame = spark.createDataFrame(
        [("g", 4.5, 40), ("g", 4.5, 35), ("g", 4.6, 50), ("h", None, 1)], "g string, r double, n int"
    )
    best = top_k_per_group(frame, ["g"], [F.desc("r"), F.asc("n")], 2)
    assert rows(best) == [("g", 4.5, 35), ("g", 4.6, 50), ("h", None, 1)]
