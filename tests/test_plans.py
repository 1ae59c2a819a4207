"""Physical plans: what is shuffled, sorted and pushed down."""

import re

import pytest

from gapweave import catalog
from gapweave.operators import segment

WINDOWED = ["sequence_ids", "post_calibration_purge", "resequence_after_purge", "gap_fill_full", "length_filter_window"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", WINDOWED)
def test_one_exchange_serves_all_windows(spark, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    assert len(re.findall(r"Exchange ", text)) == 1 and "hashpartitioning(user_id" in text
    assert len(re.findall(r"Sort \[user_id", text)) <= 2  # by time, and once more by sequence for the count


@pytest.mark.parametrize("name", ["full_pipeline", "full_pipeline_unkeyed"])
def test_the_fallback_is_a_subquery_on_the_same_exchange(spark, sf_dir, name):
    jobs = lambda: set(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    df = catalog.QUERIES[name](spark, sf_dir)
    assert len(jobs() - before) <= 1  # the schema of the file, nothing else has run
    df.collect()
    text = plan(df)
    final = text[: text.index("Initial Plan")] if "Initial Plan" in text else text
    assert "Subquery" in text and "ReusedExchange" in final
    if name == "full_pipeline":
        assert len(re.findall(r"Exchange hashpartitioning\(user_id", text.split("== Initial Plan ==")[0])) <= 1


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_python_and_few_columns(spark, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct", text)
    assert "props" not in text
    assert "NestedLoop" not in text


def test_events_are_filtered_in_the_scan_stage(spark, sf_dir):
    text = plan(catalog.QUERIES["drop_calibration_events"](spark, sf_dir))
    assert "IsNotNull(ts)" in text and "Exchange" not in text


def test_a_single_series_is_not_one_task(spark, sf_dir):
    text = plan(segment(catalog.cleaned(spark, sf_dir), catalog.SINGLE, 15, outages=(30, 2)))
    single = [line for line in text.splitlines() if "SinglePartition" in line]
    assert len(single) == 1 and len(re.findall(r"hashpartitioning\(_span", text)) == 2
    below = text[text.index("SinglePartition") :]
    assert "Aggregate(key" in below  # only the table with one row a span
