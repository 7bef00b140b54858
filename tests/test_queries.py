"""Every registered query against its SQL on the smallest tables."""

import re

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from validation.compare import connect, differences
from validation.frames import Frames
from validation.oracle import all_oracle_sql
from validation.queries import all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(all_queries()) == set(all_oracle_sql())
    assert set(all_queries()) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, FOLDER, name) is None


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert frame.columns[:2] == ["city", "year"]
    assert frame.count() > 0


def test_reviews_hold_whole_documents(spark):
    """Every character of every document that is a comment, but for the quotes around it."""
    frames = Frames(spark, FOLDER)
    texts = frames.stays.join(frames.table("documents"), "doc_id").where("length(text) > 0")
    expected = texts.agg(F.count("*"), F.sum(F.length("text"))).first()
    reviews = all_queries()["scan_review_text_split"](spark, FOLDER)
    comment = F.regexp_replace("comment", '"', "")
    assert reviews.agg(F.count("*"), F.sum(F.length(comment))).first() == expected


@pytest.mark.parametrize("name", ["warehouse_roundtrip", "warehouse_run_ids"])
def test_repeated_inserts_read_the_tables_once(spark, monkeypatch, name):
    plans = []
    insert = DataFrameWriter.insertInto

    def seen(writer, *args, **kwargs):
        plans.append(writer._df._jdf.queryExecution().optimizedPlan().toString())
        return insert(writer, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "insertInto", seen)
    all_queries()[name](spark, FOLDER)
    assert len(plans) == 2
    # Neither the words of the texts nor the order lines.
    assert not any("l_orderkey" in plan or "word" in plan for plan in plans)


def test_words_of_a_large_lexicon_are_counted_without_moving_by_text_and_word(spark):
    plan = all_queries()["sentiment_large_lexicon"](spark, FOLDER)._jdf.queryExecution().executedPlan()
    assert "hashpartitioning(doc_id" in plan.toString()
    assert not re.search(r"hashpartitioning\(doc_id#\d+L?, word", plan.toString())
