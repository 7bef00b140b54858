import csv
import datetime
import io
import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from conftest import rows
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodgestar.functions import parsing
from lodgestar.sources import blocks
from lodgestar.sources import reviews as reviews_module
from lodgestar.sources import (
    RawLayout,
    check_required,
    read_calendar,
    read_lexicon,
    read_listings,
    read_reviews,
    rejected_calendar_rows,
    rejected_listing_rows,
    rejected_review_rows,
    required_field_nulls,
    spread,
)
from lodgestar.sources.csv import read_named_csv

day = datetime.date
HEADER = (
    "id,name,host_id,host_name,neighbourhood_group,neighbourhood,latitude,longitude,room_type,price,"
    "minimum_nights,number_of_reviews,last_review,reviews_per_month,"
    "calculated_host_listings_count,availability_365"
)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def test_listings_of_several_cities(spark, tmp_path):
    berlin = (
        HEADER + '\n1,"Big ""loft"",\nquiet",10,Ann,Mitte,Alex,52.5,13.4,Private room,50,1,3,'
        "2018-01-01,0.5,1,365\n"
    )
    # Other column order, upper case, one column more.
    names = list(reversed(HEADER.split(",")))
    values = dict(zip(HEADER.split(","), "2,Flat,11,,Sol,Sol,40.4,-3.7,Entire home/apt,70,2,0,,,1,0".split(","), strict=True))
    madrid = (
        "extra," + ",".join(names).upper() + "\nx," + ",".join(values[n] for n in names) + "\n"
    )
    layout = RawLayout(str(tmp_path), cities=("BERLIN", "MADRID"))
    write(tmp_path / "listing/BerlinListings.csv", berlin)
    write(tmp_path / "listing/MadridListings.csv", madrid)
    frame = read_listings(spark, layout.listings())
    assert rows(frame, "id", "name", "host_id", "host_name", "price", "reviews_per_month", "city") == [
        (1, 'Big "loft",\nquiet', 10, "Ann", 50, 0.5, "BERLIN"),
        (2, "Flat", 11, None, 70, None, "MADRID"),
    ]
    assert frame.schema["host_id"].dataType.simpleString() == "bigint"


def test_missing_column_is_reported(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name\n1,x\n")
    with pytest.raises(ValueError, match="host_id"):
        read_listings(spark, {"BERLIN": path})


def test_bad_listing_values(spark, tmp_path):
    lines = [
        "1,a,10,Ann,g,n,1.0,2.0,Private room,cheap,1,3,,,1,365",
        "2,b,10,Ann,g,n,1.0,2.0,Private room,,1,3,,,1,365",
        "3,c,10,Ann,g,n,1.0,2.0,Private room,30,1,3,,,1,365",
    ]
    paths = {"BERLIN": write(tmp_path / "a.csv", "\n".join([HEADER, *lines]) + "\n")}
    with pytest.raises(PySparkException):
        read_listings(spark, paths).collect()
    lenient = read_listings(spark, paths, on_error="null")
    assert rows(lenient, "id", "price") == [(1, None), (2, None), (3, 30)]
    assert rows(rejected_listing_rows(spark, paths), "id", "price") == [("1", "cheap"), ("2", None)]
    nulls = required_field_nulls(lenient).collect()[0]
    assert (nulls["rows"], nulls["price"], nulls["host_id"]) == (3, 2, 0)
    with pytest.raises(PySparkException, match="listing without price"):
        check_required(lenient).collect()
    # A mere count reads no field, so it checks none.
    assert check_required(lenient).select("id").count() == 3


@pytest.mark.parametrize("multi_line", [False, True])
def test_calendar(spark, tmp_path, multi_line):
    first = write(
        tmp_path / "a.csv",
        'listing_id,date,available,price\n1,2018-01-01,t,"$1,234.00"\n1,2018-01-02,f,\n',
    )
    second = write(tmp_path / "b.csv", "listing_Id,date,available,price\n2,2018-01-01,T,$5.00\n")
    frame = read_calendar(spark, [first, second], multi_line=multi_line)
    assert rows(frame) == [
        (1, day(2018, 1, 1), True, 1234.0),
        (1, day(2018, 1, 2), False, None),
        (2, day(2018, 1, 1), False, 5.0),
    ]


def test_bad_calendar_rows(spark, tmp_path):
    path = write(
        tmp_path / "a.csv",
        "listing_id,date,available,price\n1,2018-1-1,t,$5\n2,2018-01-01,t,five\n3,2018-01-01,t,$5\n"
        ",2018-01-01,t,$5\n",
    )
    for column in ("listing_id", "date", "price"):
        with pytest.raises(PySparkException):
            read_calendar(spark, path).select(column).collect()
    assert read_calendar(spark, path).select("available").count() == 4
    assert rows(read_calendar(spark, path, on_error="null"), "listing_id", "date", "price") == [
        (None, day(2018, 1, 1), 5.0),
        (1, None, 5.0),
        (2, day(2018, 1, 1), None),
        (3, day(2018, 1, 1), 5.0),
    ]
    assert rows(rejected_calendar_rows(spark, path), "listing_id") == [(None,), ("1",), ("2",)]


def split_reads(spark, split_bytes, read):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        return read()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


field = st.text(st.sampled_from('ab ,"\n;é\t日'), max_size=12)


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=list(HealthCheck),
    phases=[Phase.generate],
)
@given(
    st.lists(st.lists(st.tuples(field, field, field), max_size=30), min_size=1, max_size=3),
    st.sampled_from(["\n", "\r\n"]),
    st.booleans(),
    st.sampled_from([40, 100, 300, 1000]),
)
def test_quoted_records_are_read_alike_in_splits(spark, tmp_path_factory, files, end, last, size):
    """Splitting CSV files gives what Spark's multi-line reader gives.

    Where a block is so small that a record covers it, the job fails instead.
    """
    folder = tmp_path_factory.mktemp("records")
    for n, records in enumerate(files):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator=end)
        writer.writerow(["b", "A", "c"])
        writer.writerows(records)
        text = out.getvalue() if last else out.getvalue().removesuffix(end)
        write(folder / f"{n}.csv", text)

    def found(mode):
        return rows(read_named_csv(spark, str(folder), ["a", "b", "c"], mode=mode))

    whole = found("whole")
    assert found("split") == whole
    try:
        assert split_reads(spark, size, lambda: found("split")) == whole
    except PySparkException as error:
        assert "reaches far into the next block" in str(error) and size < 300


def test_large_listing_file_is_read_by_many_tasks(spark, tmp_path):
    draw = random.Random(3)
    lines = [HEADER]
    for n in range(2_000):
        title = draw.choice(["Flat", '"Loft, ""big""\n\nquiet"', '"two\nlines"'])
        lines.append(f"{n},{title},10,Ann,g,n,1.0,2.0,Private room,{n % 90},1,3,,,1,365")
    path = write(tmp_path / "a.csv", "\n".join(lines) + "\n")

    def read(mode):
        frame = read_listings(spark, {"BERLIN": path}, mode=mode)
        return frame, rows(frame, "id", "name", "price"), frame.rdd.getNumPartitions()

    whole, expected, tasks = read("whole")
    assert tasks == 1
    split, found, tasks = split_reads(spark, 4096, lambda: read("split"))
    assert found == expected and len(found) == 2_000 and tasks > 20
    # Only the table of blocks moves.
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    moved = [line for line in plan.splitlines() if "Exchange hash" in line]
    assert moved and all("hashpartitioning(file" in line for line in moved)
    assert "value" not in plan[plan.index("Exchange hash") :].split("MapInArrow")[0]


def test_stray_quotes_and_long_overhangs_are_refused(spark, tmp_path, monkeypatch):
    stray = write(tmp_path / "a.csv", 'a,b\n1,5" pipe\n2,x\n3,6" pipe\n')
    with pytest.raises(PySparkException, match="quote within a field"):
        read_named_csv(spark, stray, ["a", "b"], mode="split").collect()
    assert len(read_named_csv(spark, stray, ["a", "b"], mode="whole").collect()) == 3
    unclosed = write(tmp_path / "b.csv", 'a,b\n1,"open\n2,x\n')
    with pytest.raises(PySparkException, match="quote within a field"):
        read_named_csv(spark, unclosed, ["a", "b"], mode="split").collect()
    long = write(tmp_path / "c.csv", 'a,b\n1,"' + "word\n" * 400 + '"\n2,x\n')
    read = lambda: read_named_csv(spark, long, ["a", "b"], mode="split").collect()
    with pytest.raises(PySparkException, match="reaches far into the next block"):
        split_reads(spark, 64, read)
    assert len(read()) == 2
    other = write(tmp_path / "d" / "d.csv", "a,b\n1,2\n")
    write(tmp_path / "d" / "e.csv", "b,a\n1,2\n")
    with pytest.raises(PySparkException, match="header does not conform"):
        read_named_csv(spark, str(tmp_path / "d"), ["a", "b"], mode="split").collect()
    assert other and blocks.OVERHANG >= 1 << 20


def review_text(count):
    records = []
    for n in range(count):
        comment = f'"first {n}\nsecond, line\n\nlast"' if n % 3 == 0 else f"plain {n} été"
        comment = "" if n % 7 == 0 else comment
        records.append(f"Review {n} for listing {n % 5} by x on 2018-01-{n % 28 + 1:02d}:{comment}")
    return "\n".join(records) + "\n"


@pytest.mark.parametrize("split_bytes", ["64", "100", "1000", "134217728"])
def test_split_and_whole_reading_agree(spark, tmp_path, split_bytes):
    paths = [write(tmp_path / f"{n}.txt", review_text(60 + n)) for n in range(2)]
    columns = ("listing_id", "date", "comment")
    whole = rows(read_reviews(spark, paths, mode="whole"), *columns)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        split = read_reviews(spark, paths, mode="split")
        assert rows(split, *columns) == whole
        assert split.select("review_id").distinct().count() == len(whole)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(whole) > 90


def test_split_reading_scans_once_and_shuffles_nothing(spark, tmp_path):
    path = write(tmp_path / "a.txt", review_text(20_000))

    def read():
        frame = read_reviews(spark, path)
        ids = [{tuple(r) for r in frame.select("review_id", "comment").collect()} for _ in range(2)]
        return frame, ids, frame.count(), frame.rdd.getNumPartitions()

    frame, (first, again), count, tasks = split_reads(spark, 1 << 16, read)
    assert first == again and len(first) == count > 10_000 and tasks > 8
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    assert "Exchange" not in plan and "Join" not in plan


def test_records_of_another_prefix(spark, tmp_path):
    text = review_text(300).replace("Review ", "Rezens ")
    path = write(tmp_path / "a.txt", text)
    columns = ("listing_id", "date", "comment")
    whole = rows(read_reviews(spark, path, mode="whole"), *columns)
    split = read_reviews(spark, path, prefix="Rezens ")
    assert split_reads(spark, 500, lambda: rows(split, *columns)) == whole
    assert rows(read_reviews(spark, path), *columns) == whole and len(whole) > 200


def test_cut_comment_fails_instead_of_differing(spark, tmp_path):
    text = (
        'Review 1 for listing 2 x 2018-01-01:"a quote\nReview of the flat: fine"\n'
        "Review 2 for listing 3 x 2018-01-02:next\n"
    )
    path = write(tmp_path / "a.txt", text)
    with pytest.raises(PySparkException, match="comment not closed"):
        read_reviews(spark, path).collect()
    whole = read_reviews(spark, path, mode="whole")
    assert rows(whole, "listing_id", "comment") == [
        (2, '"a quote\nReview of the flat: fine"'),
        (3, "next"),
    ]


def test_first_piece_of_a_file_gets_no_prefix(spark, tmp_path):
    text = "11 for listing 22 by bob on 2018-01-02:tail\nReview 2 for listing 3 x 2018-01-02:next\n"
    paths = [write(tmp_path / name, text) for name in ("a.txt", "b.txt")]
    for mode in ("split", "whole"):
        found = read_reviews(spark, paths, mode=mode)
        assert rows(found, "listing_id", "comment") == [(3, "next")] * 2


def test_calendar_files_bind_by_their_own_header(spark, tmp_path):
    first = write(tmp_path / "a.csv", 'listing_id,date,available,price\n1,2018-01-01,t,"$7.00"\n')
    second = write(tmp_path / "b.csv", 'price,available,date,listing_id\n"$8.00",t,2018-01-02,2\n')
    both = read_calendar(spark, [first, second])
    assert rows(both, "listing_id", "available", "price") == [(1, True, 7.0), (2, True, 8.0)]
    with pytest.raises(Exception, match="header does not conform"):
        read_calendar(spark, str(tmp_path)).collect()


piece = st.sampled_from(
    [
        "Review 1 for listing 2 x 2018-01-01:",
        "Review 22 for listing 33 2017-01-01: x 2018-01-02:",
        "Rating 5 for listing 6 x 2018-01-03:",
        '"quoted"',
        '"two\nlines"',
        '""',
        "plain",
        "Review of it",
        "\n",
        "\r\n",
        " ",
        "2018-01-09:",
    ]
)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(piece, max_size=40).map("".join), min_size=1, max_size=12))
def test_any_text_is_read_alike_or_refused(spark, tmp_path_factory, texts):
    """Whatever the files hold, splitting them gives what a search of whole files gives, or fails."""
    folder = tmp_path_factory.mktemp("texts")
    closed = []
    for n, text in enumerate(texts):
        path = write(folder / f"{n}.txt", "Review 0 for listing 1 x 2018-01-05:start\n" + text)
        try:
            read_reviews(spark, path).collect()
            closed.append(path)
        except PySparkException as error:
            assert "comment not closed" in str(error)
    columns = ("listing_id", "date", "comment")
    if closed:
        whole = rows(read_reviews(spark, closed, mode="whole"), *columns)
        assert rows(read_reviews(spark, closed), *columns) == whole
        assert len(whole) >= len(closed)


def test_rejected_reviews(spark, tmp_path):
    path = write(
        tmp_path / "a.txt",
        "Review 1 for listing 2 x 2018-1-1:bad date\nReview 2 for listing 3 x 2018-01-02:good\n",
    )
    assert rows(rejected_review_rows(spark, path)) == [("2", "2018-1-1", "bad date")]


def test_lexicon(spark, tmp_path):
    positive = [write(tmp_path / "p1", "great\nmixed\nKategorie\n"), write(tmp_path / "p2", "great\r\nbon\n")]
    negative = write(tmp_path / "n", "dirty\nmixed\n")
    assert rows(read_lexicon(spark, positive, negative)) == [
        ("Kategorie", 1, 0),
        ("bon", 1, 0),
        ("dirty", 0, 1),
        ("great", 1, 0),
        ("mixed", 1, 1),
    ]
    assert ("kategorie", 1, 0) in rows(read_lexicon(spark, positive, negative, normalize=True))


def test_spread_moves_rows_as_told(spark):
    few, many = spark.range(100, numPartitions=1), spark.range(100, numPartitions=9)
    for frame in (few, many):
        assert spread(frame, 8, "id").rdd.getNumPartitions() == 8
        assert spread(frame, None, "id") is frame


def test_strict_listings_fail_on_any_bad_field(spark):
    from lodgestar.schemas import LISTING_FIELDS

    good = {name: "1" for name in LISTING_FIELDS}

    def ids(row):
        raw = spark.createDataFrame([row], ", ".join(f"{name} string" for name in good))
        typed = raw.select(*[F.col(n).cast(kind).alias(n) for n, (kind, _) in LISTING_FIELDS.items()])
        return check_required(typed).select("id").collect()

    assert ids(good) == [(1,)]
    for name, (kind, needed) in LISTING_FIELDS.items():
        if needed:
            with pytest.raises(Exception, match=f"listing without {name}"):
                ids({**good, name: None})
        if kind.simpleString() != "string":
            with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
                ids({**good, name: "abc"})


def test_records_with_a_place_have_the_text_of_the_pattern(spark):
    head = "Review 1 for listing 7 by a on 2018-01-01:"
    texts = [
        head + "plain", head + '"quoted\nlines" left over', head + '""', "before " + head + "late",
        head + 'at 9:30 on 2018-02-02:"x"', f'{head}a\n{head}"b"\nno record', "no record", "", head,
        head + "sepa\x1frated", head + "line\nnext line", "Re: " + head + "more", None,
    ]
    pieces = spark.createDataFrame(list(enumerate(texts)), "row long, value string").selectExpr(
        "value", "'f' AS file", "0L AS block", "row"
    )
    found = reviews_module._records(pieces).select("row", "match", "field")
    matches = pieces.select("row", F.explode(parsing.review_matches(F.col("value"))).alias("match"))
    expected = matches.select("row", "match", parsing.review_fields(F.col("match")).alias("field"))
    assert rows(found) == rows(expected) and len(rows(found)) == 9
    plain = reviews_module._records(pieces.select("value"))
    assert rows(plain) == rows(expected.select("field"))


def test_records_are_found_in_one_pass_whatever_the_text_holds(spark):
    texts = [
        "Review 1 for listing 2 by a guest on 2018-01-02:plain\nReview 2 for listing 3 by x on 2018-01-03:\"a\nb\"",
        "Review 1 for listing 2 by a guest on 2018-01-02:with \x1e and \x1f\nReview 2 for listing 3 by x on 2018-01-03:b",
        "no record",
        "",
        None,
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    one = frame.select(F.posexplode_outer(parsing.review_records(F.col("value")))).where("pos % 2 = 1")
    found = one.select(parsing.split_fields(F.col("col")).alias("field"))
    each = frame.select(F.explode(parsing.review_matches(F.col("value"))).alias("match"))
    expected = each.select(parsing.review_fields(F.col("match")).alias("field"))
    assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in expected.collect())
    assert found.count() == 4


def test_raw_review_files_are_packed_and_small(spark):
    """However many reviews a text has, no file holds more than so many, and copies cost little."""
    from validation import queries

    number, text = queries.RECORDS_PER_FILE * 2 + 10, "some words of a guest " * 20
    records = spark.range(0, number, 1, 1).select(
        F.format_string(f"Review %d for listing 7 by a guest on 2018-01-02:{text}", "id").alias("value")
    )
    path = queries._write_reviews(SimpleNamespace(spark=spark), records)
    sizes = [f.stat().st_size for f in Path(path.removeprefix("file:")).glob("part-*")]
    assert len(sizes) == 3 and sum(sizes) < number * len(text) / 5
    for mode in ("split", "whole"):
        reviews = read_reviews(spark, path, mode=mode)
        assert reviews.where(F.col("comment") == text).count() == number


def test_single_records_are_found_as_the_pattern_finds_them(spark):
    """A text that is one record is told by its head and comment; any other is left to the pattern."""
    head = "Review 1 for listing 2 by a guest on 2018-01-02"
    sure = [
        f"{head}:plain",
        f'{head}:"two\nlines"',
        f'{head}:"closed" and more',
        f"{head}:first line\nsecond line",
        f"{head}:a colon: and a dash - 2018-01-02",
        f"{head}:with \x1f and \x1e and ünï\U0001f600",
        f"Review 1 for listing 2 by 2017-01-01 guest on 12018-01-02:{'x' * 9000}",
    ]
    other = [
        f"{head}:later 2019-03-04:counts",
        f'{head}:"a" for listing 5 of 2019-03-04:b',
        f'{head}:"two\nabcdef 3 for listing 4 by x on 2019-03-04:c"',
        f"{head}:\nReview 3 for listing 4 by x on 2019-03-04:c",
        f'{head}:"',
        f'{head}:""',
        f"{head}:",
        head,
        f"x{head}:plain",
        "Review 1 for listing 2 by a: guest on 2018-01-02:plain",
        "Review 1 for listing 2 by a guest on 2018-01-02:plain",
        f"at 10:30 {head}:plain",
        "",
    ]
    # Of every two and three parts, with what ends lines, dates and comments between them.
    parts = [head, ":", '"', "\n", "\x85", "a", "9:", " 2019-03-04:"]
    random.seed(5)
    mixed = [head + "".join(random.choices(parts, k=random.randint(1, 6))) for _ in range(400)]
    texts = [*sure, *other, *mixed]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, value string")
    by_pattern = frame.select("id", F.posexplode(parsing.review_records(F.col("value"))))
    expected = {}
    for row in by_pattern.where("pos % 2 = 1").collect():
        expected.setdefault(row["id"], []).append(row["col"])
    cut = frame.select("id", *parsing.head_and_rest(F.col("value")))
    cut = cut.select("id", "head", parsing.leading_comment(F.col("rest")).alias("comment"))
    single = cut.select("id", parsing.single_record(F.col("head"), F.col("comment")).alias("one"))
    found = {row["id"]: row["one"] for row in single.collect()}
    assert all(found[i] is not None for i in range(len(sure)))
    assert all(expected[i] == [one] for i, one in found.items() if one is not None)
    read = reviews_module._records(frame.select("value")).select("field").collect()
    fields = [one.split("\x1f", 2) for ones in expected.values() for one in ones]
    assert sorted(row["field"] for row in read) == sorted(fields)


def test_forms_of_a_document_are_made_once_however_few_its_stays(spark):
    from validation.frames import Frames

    frames = Frames(spark, "/root/testdata/sf0.001")
    plan = frames.review_records._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
