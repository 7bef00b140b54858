"""Shape of the physical plans: what would hurt on large inputs must not be in them."""

import re

import pytest

from validation.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
# These write raw files or tables while they are built; their reads are covered by the others.
WRITING = {
    "load_lexicon",
    "rejected_rows",
    "scan_calendar_csv",
    "scan_listings_csv",
    "scan_listings_csv_whole",
    "scan_review_text_split",
    "scan_review_text_whole",
    "warehouse_append",
    "warehouse_by_city",
    "warehouse_full_load",
    "warehouse_merge_load",
    "warehouse_rejects",
    "warehouse_run_ids",
    "warehouse_roundtrip",
}


def plan_of(spark, name):
    return all_queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(all_queries()) - WRITING))
def test_no_python_rows_and_no_cross_join(spark, name):
    plan = plan_of(spark, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "MapElements"):
        assert node not in plan, f"{node} in the plan of {name}"


def test_top_k_is_limited_before_its_shuffle(spark):
    plan = plan_of(spark, "top_hosts_per_group")
    partial = plan.index("WindowGroupLimit", plan.index("WindowGroupLimit") + 1)
    shuffle = plan.index("Exchange hashpartitioning(city")
    assert plan.index("WindowGroupLimit") < shuffle < partial


def test_latest_years_read_the_facts_once(spark):
    frame = all_queries()["latest_year_hosts"](spark, FOLDER)
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"FileScan orc \S+\.tof_reviews\[", final)) == 1
    assert "ReusedExchange [city" in final


def test_texts_are_not_shuffled(spark):
    """Between the scan of a document and its counts only key and counts move."""
    frame = all_queries()["rate_extracted_reviews"](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    before_shuffle = re.findall(r"Exchange hashpartitioning\(review_id.*?\n(.*?)\n", plan)
    assert before_shuffle and all("partial_sum" in line for line in before_shuffle)


def test_scans_read_only_used_columns(spark):
    plan = plan_of(spark, "dim_date")
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan)
    assert set(schemas) == {
        "o_orderdate:timestamp_ntz",
        "l_orderkey:bigint",
        "o_orderkey:bigint,o_orderdate:timestamp_ntz",
    }


def test_city_filter_reaches_the_scan(spark, tmp_path):
    from lodgestar.operators.star import Star
    from lodgestar.plans import analyses, warehouse

    warehouse.create_warehouse(spark, "plans")
    star = Star.from_catalog(spark, "plans")
    table = analyses.reviews_by_year(star, "BERLIN", values=["A"])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(city,BERLIN)" in plan
    assert "declared_reviews_count" not in plan
