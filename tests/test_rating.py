import re

import pyarrow as pa
import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from lodgestar.operators import sentiment
from lodgestar.operators.sentiment import possible_hits, rate_reviews, rate_texts
from lodgestar.session import stage
from lodgestar.sources import lexicon_from_words

POSITIVE = ["great", "clean", "mixed", "Kategorie"]
NEGATIVE = ["dirty", "noisy", "mixed"]


def lexicon(spark, positive=POSITIVE, negative=NEGATIVE):
    return lexicon_from_words(
        spark.createDataFrame([(w,) for w in positive], "word string"),
        spark.createDataFrame([(w,) for w in negative], "word string"),
    )


def rate(spark, comments, words=None):
    texts = spark.createDataFrame(list(enumerate(comments)), "id long, text string")
    rated = rate_texts(texts, words or lexicon(spark), key="id", text="text")
    return {row["id"]: (row["positive"], row["negative"], row["rating"]) for row in rated.collect()}


def by_hand(comment):
    words = [w.lower() for w in re.sub('[".?!,]', "", comment).split(" ")]
    p, n = (sum(w in side for w in words) for side in (set(POSITIVE), set(NEGATIVE)))
    return p, n, 2.5 if p + n == 0 else ((p - n) / (p + n) + 1) * 2.5


def test_cases(spark):
    cases = {
        "great great dirty": (2, 1, (1 / 3 + 1) * 2.5),
        "Great, clean! place.": (2, 0, 5.0),
        "dirty\ngreat": (0, 0, 2.5),
        "good-dirty great": (1, 0, 5.0),
        "noisy": (0, 1, 0.0),
        "mixed": (1, 1, 2.5),
        "nothing here": (0, 0, 2.5),
        "Kategorie": (0, 0, 2.5),
        '"great  dirty "': (1, 1, 2.5),
        "": (0, 0, 2.5),
    }
    rated = rate(spark, list(cases))
    assert [rated[i] for i in range(len(cases))] == list(cases.values())


token = st.sampled_from([*POSITIVE, *NEGATIVE, "GREAT", "Dirty!", "x", "", "a-b", "gr.eat", "\n"])
comment = st.lists(token, max_size=12).map(" ".join)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(comment, min_size=1, max_size=30))
def test_matches_a_hand_count_in_range(spark, comments):
    rated = rate(spark, comments)
    assert [rated[i] for i in range(len(comments))] == [by_hand(c) for c in comments]
    assert all(0 <= value[2] <= 5 for value in rated.values())


def test_swapping_polarity_mirrors_the_rating(spark):
    comments = ["great great dirty", "noisy", "mixed x", "clean", "plain"]
    normal, swapped = rate(spark, comments), rate(spark, comments, lexicon(spark, NEGATIVE, POSITIVE))
    for i in range(len(comments)):
        assert abs(normal[i][2] - (5 - swapped[i][2])) < 1e-12


def test_equal_reviews_are_rated_separately(spark):
    reviews = spark.createDataFrame(
        [(i, 7, "great") for i in range(3)], "review_id long, listing_id long, comment string"
    ).selectExpr("review_id", "listing_id", "date'2018-01-01' AS date", "comment")
    rated = rate_reviews(reviews, lexicon(spark))
    assert rows(rated, "review_id", "rating") == [(0, 5.0), (1, 5.0), (2, 5.0)]


def test_copies_of_a_text_are_rated_once_and_all_come_back(spark):
    texts = ["great", "dirty noisy", "great", None, "", "great", None, "plain"]
    reviews = spark.createDataFrame(
        [(i, None if i == 4 else i % 3, t) for i, t in enumerate(texts)],
        "review_id long, listing_id long, comment string",
    ).selectExpr("review_id", "listing_id", "date'2018-01-01' AS date", "comment")
    packed = sentiment.pack_copies(reviews.coalesce(1), key="review_id", text="comment")
    sizes = packed.selectExpr("review_id", "comment", "size(rows) AS n")
    assert rows(sizes) == [(0, "great", 3), (1, "dirty noisy", 1), (3, None, 2), (4, "", 1), (7, "plain", 1)]
    expected = [
        (0, 0, 5.0), (1, 1, 0.0), (2, 2, 5.0), (3, 0, 2.5), (4, None, 2.5),
        (5, 2, 5.0), (6, 0, 2.5), (7, 1, 2.5),
    ]
    staged = stage(lexicon(spark), "lexicon")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for threshold in (before, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            rated = rate_reviews(reviews, staged)
            assert rows(rated, "review_id", "listing_id", "rating") == expected
            plan = rated._jdf.queryExecution().executedPlan().toString()
            assert ("MapInArrow" in plan) == (threshold == before)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hits_are_added_up_in_the_task(spark):
    """Same as by a shuffle, also where the hits of a text are in several batches, or a batch has none."""
    comments = ["great " * 9 + "dirty", None, "", "noisy", "plain words", "mixed clean", "great " * 7]
    texts = spark.createDataFrame(
        [(n, [f"r{n}"], c) for n, c in enumerate(comments)], "id long, rows array<string>, text string"
    )
    staged = stage(lexicon(spark, positive=[*POSITIVE, " ", "two words"]), "lexicon")
    expected = rate_texts(texts, staged, key="id", text="text", keep=["rows"], prefilter=False)
    expected = rows(expected, "id", "rows", "positive", "negative")
    conf = {"spark.sql.execution.arrow.maxRecordsPerBatch": "3", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        for parts in (1, 3):
            found = sentiment.count_in_task(
                texts.coalesce(1).repartition(parts), staged, key="id", text="text", keep="rows"
            )
            assert rows(found) == expected
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    reviews = texts.selectExpr("id AS review_id", "id AS listing_id", "text AS comment")
    assert rows(rate_reviews(reviews, staged, in_task=True)) == rows(rate_reviews(reviews, staged))


def test_hits_out_of_order_fail():
    names = ("id", "rows", "positive", "negative")

    def batch(*hits):
        columns = {"id": [h[0] for h in hits], "is_end": [h[1] for h in hits]}
        return pa.RecordBatch.from_pydict(
            columns | {"rows": ["x"] * len(hits), "positive": [1] * len(hits), "negative": [0] * len(hits)}
        )

    def added(*batches):
        return [row for b in sentiment._add_up(names)(iter(batches)) for row in b.to_pylist()]

    found = added(batch((1, False), (1, False)), batch((1, True), (2, True), (3, False)), batch((3, True)))
    assert [(row["id"], row["positive"]) for row in found] == [(1, 3), (2, 1), (3, 2)]
    for mixed in (
        [batch((1, False), (2, False), (1, True), (2, True))],
        [batch((1, False)), batch((2, True))],
        [batch((1, True), (2, False))],
    ):
        with pytest.raises(RuntimeError):
            added(*mixed)


def test_same_result_with_a_shuffled_lexicon(spark):
    comments = ["great great dirty", "noisy", "none of these", "great " * 50]
    expected = rate(spark, comments)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rate(spark, comments) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_lexicon_shuffles_only_possible_words(spark, monkeypatch):
    """Rows that leave the tasks grow with the texts and their hits, not with their words."""
    many = lexicon(spark, [f"plus{i}" for i in range(3_000)], ["minus 1", " 4", *NEGATIVE])
    comments = [f"plus{i} Plus{i} minus dirty " + " ".join(f"x{i}y{j}" for j in range(300)) for i in range(200)]
    texts = spark.createDataFrame([*enumerate(comments), (900, None), (None, "noisy")], "id long, text string")
    found = possible_hits(texts, many, key="id", text="text").collect()
    known = [r for r in found if not r.word.startswith(" ")]
    # Per text two hits and one row for all other words; few false positives of 60,000 words.
    assert len(found) - len(known) == 201 and 401 <= len(known) <= 441
    assert {r.n for r in known if r.word == "plus7"} == {2}
    rated = rate_texts(texts, many, key="id", text="text", prefilter=True)
    plain = rate_texts(texts, many, key="id", text="text", prefilter=False)
    assert rows(rated) == rows(plain)
    assert (900, 0, 0, 2.5) in rows(rated) and (None, 0, 1, 0.0) in rows(rated)
    # A filter that lets nearly everything pass costs rows, never a result.
    monkeypatch.setattr(sentiment, "BLOOM_ROWS", 2)
    assert rows(rate_texts(texts, many, key="id", text="text", prefilter=True)) == rows(plain)


def test_the_filter_is_tested_before_the_first_shuffle(spark):
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rated = rate_texts(texts, lexicon(spark), key="doc_id", text="text", prefilter=True)
    plan = rated._jdf.queryExecution().executedPlan().toString()
    counted = plan.split("Exchange hashpartitioning(doc_id")[-1]
    assert "partial_count" in counted.splitlines()[1] and "BroadcastHashJoin" in counted
    first = counted[: counted.index("BroadcastHashJoin")]
    assert "partial_count" in first and "Exchange" not in first


def test_the_size_of_the_lexicon_chooses_the_way(spark, tmp_path):
    lexicon(spark).write.parquet(str(tmp_path / "words"))
    stored = spark.read.parquet(str(tmp_path / "words"))
    assert sentiment.fits_broadcast(stored)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        assert not sentiment.fits_broadcast(stored)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_hits_and_a_mark_per_text_are_counted(spark):
    texts = spark.createDataFrame(
        [(1, "good good bad"), (2, "none of them"), (3, None), (4, ""), (5, " good  ")], "k long, t string"
    )
    lexicon = spark.createDataFrame(
        [("good", 1, 0), ("bad", 0, 1), (" ", 1, 1), ("none of", 1, 0)],
        "word string, positive int, negative int",
    )
    counts = sentiment.count_hits(texts, lexicon, key="k", text="t", prefilter=False)
    assert rows(counts) == [(1, 2, 1), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 1, 0)]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("partial_sum")
    assert 0 < plan.index("Filter", partial) < plan.index("Join", partial)
