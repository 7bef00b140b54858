import datetime
import re
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from test_sources import HEADER, write

from lodgestar.__main__ import main
from lodgestar.operators import dimensions, facts
from lodgestar.operators.star import Star
from lodgestar.plans import analyses, warehouse
from lodgestar.plans.merge import merge_dimension
from lodgestar.schemas import WAREHOUSE_TABLES
from lodgestar.session import scratch_path
from lodgestar.sources import RawLayout
from lodgestar.staging import Staging, settings

day = datetime.date


@pytest.fixture
def raw(tmp_path):
    """Two cities; listing 1 has a review on a day with and one on a day without calendar row."""
    berlin = [
        '1,"Loft, ""nice""\nquiet",10,Ann,Mitte,Alex,52.5,13.4,Private room,50,1,3,,,1,365',
        "2,Flat,11,Bob,Nord,Wedding,52.5,13.4,Entire home/apt,80,1,5,,,1,365",
    ]
    paris = ["3,Flat,11,Bob,Louvre,Louvre,48.8,2.3,Entire home/apt,90,1,7,,,1,365"]
    for city, lines in (("Berlin", berlin), ("Paris", paris)):
        write(tmp_path / f"listing/{city}Listings.csv", "\n".join([HEADER, *lines]) + "\n")
    calendar = "listing_id,date,available,price\n"
    write(
        tmp_path / "calendar/BerlinCalendar.csv",
        calendar + '1,2018-01-01,f,\n2,2018-01-01,t,"$1,000.00"\n',
    )
    write(tmp_path / "calendar/ParisCalendar.csv", calendar + "3,2019-05-05,t,$95.00\n")
    write(
        tmp_path / "review/BerlinReviews.txt",
        "Review 1 for listing 1 by a on 2018-01-01:great, clean!\n"
        'Review 2 for listing 1 by b on 2018-01-02:"dirty\nbut great "\n'
        "Review 3 for listing 2 by c on 2018-01-01:noisy\n"
        "Review 4 for listing 77 by c on 2017-01-01:unlisted\n",
    )
    write(
        tmp_path / "review/ParisReviews.txt",
        "Review 5 for listing 3 by d on 2019-03-04:nothing\n",
    )
    write(tmp_path / "words/positive", "great\nclean\n")
    write(tmp_path / "words/negative", "dirty\nnoisy\n")
    return tmp_path


def inputs(spark, raw, **options):
    return warehouse.Inputs.from_files(
        spark,
        RawLayout(str(raw), cities=("BERLIN", "PARIS")),
        str(raw / "words/positive"),
        str(raw / "words/negative"),
        **options,
    )


FACTS = [
    ("Alex", day(2018, 1, 1), "10", "Private room", 0, 1, None, 5.0, 3),
    ("Alex", day(2018, 1, 2), "10", "Private room", 1, 0, 50.0, 5.0, 3),
    ("Louvre", day(2019, 3, 4), "11", "Entire home/apt", 1, 0, 90.0, 2.5, 7),
    ("Wedding", day(2018, 1, 1), "11", "Entire home/apt", 1, 0, 1000.0, 0.0, 5),
]


@pytest.mark.parametrize(
    "file_format, by_year, mode", [("orc", False, "whole"), ("orc", True, "split"), ("parquet", True, "split")]
)
def test_load_from_files(spark, raw, file_format, by_year, mode):
    database = f"load_{file_format}_{by_year}"
    warehouse.create_warehouse(spark, database, file_format=file_format, fact_by_year=by_year)
    for _ in range(2):  # a repeated load replaces
        warehouse.load_warehouse(spark, inputs(spark, raw, review_mode=mode), database)
    star = Star.from_catalog(spark, database)
    names = [name for name, _ in WAREHOUSE_TABLES["tof_reviews"]]
    assert rows(star.fact, *names[1:]) == FACTS
    assert rows(star.room_type) == [("Entire home/apt",), ("Private room",)]
    assert rows(star.neighbourhood) == [
        ("Alex", "Mitte", "BERLIN"),
        ("Louvre", "Louvre", "PARIS"),
        ("Wedding", "Nord", "BERLIN"),
    ]
    assert rows(star.host) == [("10", "Ann"), ("11", "Bob")]
    # The date of the review without listing and the calendar date without review are in.
    assert rows(star.date, "date", "year") == [
        (day(2017, 1, 1), 2017),
        (day(2018, 1, 1), 2018),
        (day(2018, 1, 2), 2018),
        (day(2019, 3, 4), 2019),
        (day(2019, 5, 5), 2019),
    ]
    table = analyses.reviews_by_year(star, "BERLIN")
    assert [tuple(r) for r in table.collect()] == [(2018, 1, 2)]
    assert rows(analyses.top_hosts(star, "BERLIN", min_reviews=0, k=1)) == [
        ("Mitte", "Ann", 5.0, 2),
        ("Nord", "Bob", 0.0, 1),
    ]


def test_listing_without_price_fails_the_load_or_counts_without_it(spark, raw):
    path = raw / "listing/ParisListings.csv"
    path.write_text(path.read_text().replace(",90,1,7,", ",,1,7,"))
    warehouse.create_warehouse(spark, "holes")
    with pytest.raises(PySparkException, match="listing without price"):
        warehouse.load_warehouse(spark, inputs(spark, raw), "holes")
    warehouse.load_warehouse(spark, inputs(spark, raw, on_error="null"), "holes")
    paris = spark.table("holes.tof_reviews").where("neighbourhood = 'Louvre'")
    assert rows(paris, "available_listings_count", "prices_sum") == [(1, None)]


def staged_databases(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    left = [p for p in Path(root).glob("lodgestar/staging-*")]
    named = [d.name for d in spark.catalog.listDatabases() if d.name.startswith("lodgestar_staging")]
    return left, named


def test_staged_tables_are_gone_after_a_load(spark, raw):
    warehouse.create_warehouse(spark, "cleaned")
    warehouse.load_warehouse(spark, inputs(spark, raw), "cleaned")
    assert staged_databases(spark) == ([], [])
    write(raw / "review/ParisReviews.txt", "Review 5 for listing 3 by d on 2019-3-4:bad date\n")
    with pytest.raises(PySparkException, match="not a date"):
        warehouse.load_warehouse(spark, inputs(spark, raw), "cleaned")
    assert staged_databases(spark) == ([], [])


def test_day_joins_shuffle_nothing(spark, raw):
    """Of bucketed tables only the sums per fact group move, also where no side is broadcast."""
    given = inputs(spark, raw)
    with Staging(spark) as staging, settings(
        spark,
        spark__sql__requireAllClusterKeysForCoPartition="false",
        spark__sql__autoBroadcastJoinThreshold="-1",
    ):
        loading = warehouse._Loading(staging)
        listings = loading.listings(given.listings)
        reviews = loading.reviews(given.reviews, given.lexicon)
        calendar = loading.calendar(given.calendar)
        table = facts.fact_from_days(reviews, calendar, facts.listing_groups(listings))
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 2
        shuffles = re.findall(r"Exchange (hashpartitioning\(\w+)", plan)
        assert shuffles == ["hashpartitioning(neighbourhood"]
        assert len(table.collect()) == 4


def half(raw, tmp, keep):
    """The raw files with the reviews whose number is in ``keep``."""
    folder = tmp / f"half{min(keep)}"
    for path in raw.rglob("*.*"):
        text = path.read_text()
        if "review" in str(path.parent):
            found = re.findall(r"(Review (\d+) (?:.|\n)*?\n)(?=Review|\Z)", text)
            text = "".join(record for record, number in found if int(number) in keep)
        write(folder / path.relative_to(raw), text)
    for name in ("positive", "negative"):
        write(folder / "words" / name, (raw / "words" / name).read_text())
    return folder


@pytest.mark.parametrize("by_year", [False, True])
def test_merged_halves_equal_one_load(spark, raw, tmp_path_factory, by_year):
    # One fact group has reviews in both halves.
    berlin = raw / "review/BerlinReviews.txt"
    write(berlin, berlin.read_text() + "Review 6 for listing 1 by z on 2018-01-01:dirty\n")
    tmp = tmp_path_factory.mktemp("halves")
    one, two = f"one_{by_year}", f"two_{by_year}"
    warehouse.create_warehouse(spark, one, fact_by_year=by_year)
    warehouse.load_warehouse(spark, inputs(spark, raw), one)
    warehouse.create_warehouse(spark, two, fact_by_year=by_year)
    for keep in ({1, 3}, {2, 4, 6}, {5}):
        part = half(raw, tmp, keep)
        counts = warehouse.load_warehouse(spark, inputs(spark, part), two, merge=True)
        assert counts["reviews"] == warehouse.Counts(len(keep), 0, 0)
    for name in WAREHOUSE_TABLES:
        assert rows(spark.table(f"{two}.{name}")) == rows(spark.table(f"{one}.{name}")), name
    assert len(rows(spark.table(f"{two}.tof_reviews"))) == 4
    with pytest.raises(ValueError):
        warehouse.load_warehouse(spark, inputs(spark, raw), two, merge=True, row_id="run")


def test_merge_replaces_only_the_years_it_touches(spark, raw, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("years")
    warehouse.create_warehouse(spark, "years", fact_by_year=True)
    warehouse.load_warehouse(spark, inputs(spark, half(raw, tmp, {1, 5})), "years", merge=True)

    def files():
        named = spark.table("years.tof_reviews").select("year", F.input_file_name().alias("file"))
        return {year: file for year, file in rows(named.distinct())}

    before = files()
    warehouse.load_warehouse(spark, inputs(spark, half(raw, tmp, {2})), "years", merge=True)
    after = files()
    assert before[2019] == after[2019] and before[2018] != after[2018]


def test_merged_dimensions_keep_the_smallest_row_of_a_key(spark):
    warehouse.create_warehouse(spark, "merged")
    schema = "id string, name string"

    def merge(*hosts):
        with Staging(spark) as staging:
            merge_dimension(staging, spark.createDataFrame(hosts, schema), "dim_host", "merged")
        return rows(spark.table("merged.dim_host"))

    assert merge(("1", "Bob"), ("1", "Ann"), (None, "x")) == [(None, "x"), ("1", "Ann")]
    assert merge(("1", "Cid"), ("2", None), (None, None)) == [(None, "x"), ("1", "Ann"), ("2", None)]
    assert merge(("1", "Al"), ("2", "Eve"), ("3", "y")) == [
        (None, "x"), ("1", "Al"), ("2", "Eve"), ("3", "y")
    ]
    assert merge() == [(None, "x"), ("1", "Al"), ("2", "Eve"), ("3", "y")]
    places = "name string, group string, city string"
    for found, kept in (
        (("Mitte", "B", "PARIS"), ("Mitte", "B", "PARIS")),
        (("Mitte", "A", "ROME"), ("Mitte", "B", "PARIS")),
        (("Mitte", "C", "BERLIN"), ("Mitte", "C", "BERLIN")),
    ):
        with Staging(spark) as staging:
            frame = spark.createDataFrame([found], places)
            merge_dimension(staging, frame, "dim_neighbourhood", "merged")
        assert rows(spark.table("merged.dim_neighbourhood")) == [kept]


def test_rejected_rows_are_written_by_the_load(spark, raw):
    write(
        raw / "calendar/BerlinCalendar.csv",
        "listing_id,date,available,price\n1,2018-01-01,f,\n2,2018-01-01,t,much\n2,2018-1-1,t,$1.00\n,x,t,\n",
    )
    paris = raw / "review/ParisReviews.txt"
    write(paris, paris.read_text() + "Review 6 for listing 3 by d on 2019-3-4:bad\nReview 7 for listing"
          " 99999999999999999999 by d on 2019-03-04:far\n")
    listing = raw / "listing/ParisListings.csv"
    write(listing, listing.read_text().replace(",90,1,7,", ",cheap,,7,"))
    warehouse.create_warehouse(spark, "rejects")
    counts = warehouse.load_warehouse(spark, inputs(spark, raw, on_error="null"), "rejects")
    assert counts == {
        "listings": warehouse.Counts(3, 1, 0),
        "calendar": warehouse.Counts(5, 3, 2),
        "reviews": warehouse.Counts(7, 2, 2),
    }
    table = spark.table("rejects.rejected_rows")
    found = table.select("source", "reasons", "raw", "kept", F.element_at(F.split("file", "/"), -1))
    assert rows(found) == [
        ("calendar", ["date malformed"], "2,2018-1-1,t,$1.00", False, "BerlinCalendar.csv"),
        ("calendar", ["listing_id missing", "date malformed"], ",x,t,", False, "BerlinCalendar.csv"),
        ("calendar", ["price malformed"], "2,2018-01-01,t,much", True, "BerlinCalendar.csv"),
        ("listings", ["price malformed", "minimum_nights missing"],
         "3,Flat,11,Bob,Louvre,Louvre,48.8,2.3,Entire home/apt,cheap,,7,,,1,365", True, "ParisListings.csv"),
        ("reviews", ["date malformed"], "Review 6 for listing 3 by d on 2019-3-4:bad", False, "ParisReviews.txt"),
        ("reviews", ["listing_id malformed"],
         "Review 7 for listing 99999999999999999999 by d on 2019-03-04:far", False, "ParisReviews.txt"),
    ]
    assert rows(table.select("source", "row").where("source != 'calendar'")) == [
        ("listings", 1), ("reviews", 1), ("reviews", 2)
    ]
    wedding = spark.table("rejects.tof_reviews").where("neighbourhood = 'Wedding'")
    assert rows(wedding, "available_listings_count", "prices_sum") == [(1, None)]
    # Another load replaces the list as it replaces the tables.
    warehouse.load_warehouse(spark, inputs(spark, raw, on_error="null"), "rejects")
    assert spark.table("rejects.rejected_rows").count() == 6


def test_raw_text_of_rejected_rows_is_not_shuffled(spark, raw, monkeypatch):
    """The task that reads a rejected row writes it; what is shuffled, bucketed and sorted has none."""
    paris = raw / "review/ParisReviews.txt"
    write(paris, paris.read_text() + "Review 6 for listing 3 by d on 2019-3-4:bad\n")
    plans, writers = {}, []
    staged = Staging.write

    def seen(staging, rows, name, **options):
        plans[name] = (rows.columns, rows._jdf.queryExecution().executedPlan().toString())
        writers.append(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters"))
        return staged(staging, rows, name, **options)

    monkeypatch.setattr(Staging, "write", seen)
    warehouse.create_warehouse(spark, "narrow")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    warehouse.load_warehouse(spark, inputs(spark, raw, on_error="null"), "narrow")
    told = sorted(name for name, (columns, _) in plans.items() if "reject" in columns)
    assert told == ["calendar_read", "listings_read", "reviews_read"]
    for name in ("calendar_read", "reviews_read"):
        for node in ("Exchange hashpartitioning", "Sort", "Aggregate"):
            assert node not in plans[name][1], f"{node} before {name} is written"
    # Two files are open at a time, as rows would else be sorted to part them.
    assert writers.count("2") == 6
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert rows(spark.table("narrow.rejected_rows"), "source", "raw", "kept") == [
        ("reviews", "Review 6 for listing 3 by d on 2019-3-4:bad", False)
    ]
    table = spark.table("narrow.tof_reviews")
    assert rows(table, *table.columns[1:]) == FACTS


def test_same_name_in_two_cities(spark, raw):
    path = raw / "listing/ParisListings.csv"
    path.write_text(path.read_text().replace("Louvre,Louvre", "Louvre,Alex"))
    warehouse.create_warehouse(spark, "cities", fact_by_year=True, fact_by_city=True)
    warehouse.load_warehouse(spark, inputs(spark, raw), "cities")
    star = Star.from_catalog(spark, "cities")
    assert rows(star.neighbourhood) == [
        ("Alex", "Louvre", "PARIS"), ("Alex", "Mitte", "BERLIN"), ("Wedding", "Nord", "BERLIN")
    ]
    assert [tuple(r) for r in analyses.reviews_by_year(star, "PARIS").collect()] == [(2019, 1, None)]
    assert [tuple(r) for r in analyses.reviews_by_year(star, "BERLIN").collect()] == [(2018, 1, 2)]
    with pytest.raises(ValueError):
        warehouse.load_warehouse(spark, inputs(spark, raw), "cities", merge=True)
    assert staged_databases(spark) == ([], [])


def test_run_ids_are_unique_over_appends(spark, raw):
    warehouse.create_warehouse(spark, "runs")
    for _ in range(3):
        warehouse.load_warehouse(
            spark, inputs(spark, raw), "runs", overwrite=False, row_id="run"
        )
    ids = [int(r[0]) for r in spark.table("runs.tof_reviews").select("id").collect()]
    assert len(ids) == 3 * len(FACTS) and len(set(ids)) == len(ids)


def test_written_order_of_dimensions(spark, raw):
    """Files hold ranges that do not overlap, so that a filter on the order reads few of them."""
    warehouse.create_warehouse(spark, "ordered")
    days = spark.range(4_000).select(F.date_add(F.lit("2000-01-01"), F.col("id").cast("int")).alias("date"))
    shuffled = dimensions.dim_date(days).orderBy(F.rand(3))
    names = spark.range(4_000).select(
        F.col("id").cast("string").alias("name"),
        F.lit("g").alias("group"),
        F.concat(F.lit("c"), F.lpad((F.col("id") % 40).cast("string"), 2, "0")).alias("city"),
    )
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        warehouse.insert_rows(warehouse.in_written_order("dim_date", shuffled), "dim_date", "ordered")
        warehouse.insert_rows(
            warehouse.in_written_order("dim_neighbourhood", names), "dim_neighbourhood", "ordered"
        )
    for table, column, most in (("dim_date", "date", 1), ("dim_neighbourhood", "city", 1)):
        ranges = rows(
            spark.table(f"ordered.{table}")
            .groupBy(F.input_file_name())
            .agg(F.min(column).alias("low"), F.max(column).alias("high")),
            "low",
            "high",
        )
        assert len(ranges) > 2
        assert all(high <= low for (_, high), (low, _) in zip(ranges, ranges[1:]))
        one = ranges[1][0]
        assert sum(low <= one <= high for low, high in ranges) <= most + 1


def test_append_adds_and_overwrite_replaces(spark):
    warehouse.create_warehouse(spark, "modes")
    hosts = spark.createDataFrame([("1", "Ann")], "host_id string, host_name string")
    warehouse.insert_rows(hosts, "dim_host", "modes", overwrite=False)
    warehouse.insert_rows(hosts, "dim_host", "modes", overwrite=False)
    assert rows(spark.table("modes.dim_host")) == [("1", "Ann")] * 2
    warehouse.insert_rows(hosts, "dim_host", "modes")
    assert rows(spark.table("modes.dim_host")) == [("1", "Ann")]
    warehouse.create_warehouse(spark, "modes")
    assert spark.table("modes.dim_host").count() == 0


def test_tables_have_the_contract_columns(spark):
    warehouse.create_warehouse(spark, "contract", fact_by_year=True)
    for name, columns in WAREHOUSE_TABLES.items():
        expected = [*columns, ("year", "int")] if name == "tof_reviews" else columns
        assert spark.table(f"contract.{name}").dtypes == expected
    with pytest.raises(ValueError):
        warehouse.create_warehouse(spark, "contract", file_format="csv")


def test_year_filter_skips_partitions(spark, raw):
    warehouse.create_warehouse(spark, "pruned", fact_by_year=True)
    warehouse.load_warehouse(spark, inputs(spark, raw), "pruned")
    star = Star.from_catalog(spark, "pruned")
    joined = star.fact.join(star.date.where(F.col("year") == 2019), ["date", "year"])
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year#\d+ = 2019", plan), plan
    assert joined.count() == 1


def test_scratch_folder_is_the_configured_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_command_line(spark, raw, capsys):
    words = ["--positive", str(raw / "words/positive"), "--negative", str(raw / "words/negative")]
    load = ["load", str(raw), *words, "--cities", "BERLIN", "PARIS", "--database", "commands"]
    main([*load, "--lenient", "--format", "parquet", "--normalize-lexicon"])
    assert capsys.readouterr().out.splitlines() == [
        "calendar\t3\t0\t0", "listings\t3\t0\t0", "reviews\t5\t0\t0"
    ]
    main([*load, "--into", "append", "--review-mode", "whole", "--listing-mode", "whole"])
    assert spark.table("commands.dim_host").count() == 4
    main([*load, "--into", "replace"])
    main(["reviews-by-year", "BERLIN", "--database", "commands"])
    main(["avg-price-by-month", "PARIS", "--months", "3", "--database", "commands"])
    main(["top-hosts", "BERLIN", "--min-reviews", "0", "--k", "1", "--database", "commands"])
    printed = capsys.readouterr().out.splitlines()
    assert {"2018\t1\t2", "3\t90.0\tNULL", "Mitte\tAnn\t5.0\t2"} <= set(printed)


def test_stable_ids_are_made_behind_the_shuffle_by_year(spark, raw, monkeypatch):
    warehouse.create_warehouse(spark, "late_ids", fact_by_year=True)
    keys = [("N1", datetime.date(2018, 1, 2), "7", "Loft"), (None, datetime.date(2017, 5, 6), "8", None)]
    rows_ = spark.createDataFrame(
        [("to be made", *key, 1, 0, 1.0, 2.0, 3) for key in keys],
        "id string, neighbourhood string, date date, host_id string, room_type string,"
        " available_listings_count long, not_available_listings_count long, prices_sum double,"
        " ratings_sum double, declared_reviews_count long",
    )
    plans = []
    insert = DataFrameWriter.insertInto

    def seen(writer, *args, **kwargs):
        plans.append(writer._df._jdf.queryExecution().optimizedPlan().toString())
        return insert(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "insertInto", seen)
    warehouse.insert_rows(rows_, "tof_reviews", "late_ids", stable_ids=True)
    assert plans[0].index("sha2(") < plans[0].index("RebalancePartitions")
    table = spark.table("late_ids.tof_reviews")
    expected = rows_.select(facts.stable_id(*facts.FACT_KEYS))
    assert rows(table, "id") == rows(expected)
    assert table.where("year = year(date)").count() == 2
