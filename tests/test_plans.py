"""The plans that large inputs depend on."""

import re

import pytest

from footfall.plans import catalog
from footfall.sources.testdata import read_raw_events
from tests.conftest import SF

BATCH = [n for n in catalog.queries() if not n.startswith("stream_") and n not in ("layer_days", "jsonl_events")]
PYTHON = {"ab_fisher", "ab_significance", "ab_tested_results", "ab_report", "ab_pivot_tested"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pairs_and_no_python_over_events(spark, name):
    plan = plan_of(catalog.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    if name in PYTHON:
        # The tail functions run above the last aggregate, on one row per metric.
        tails = plan.index("ArrowEvalPython")
        assert plan.index("Aggregate", tails) < plan.index("FileScan", tails)
    else:
        assert "Python" not in plan
    # A nested loop appears only between two one-row aggregates.
    if "BroadcastNestedLoopJoin" in plan:
        assert name == "cleaning_report"


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = plan_of(catalog.detail(spark, SF))
    shuffle = plan.index("Exchange hashpartitioning(event_id")
    assert plan.index("Partial", shuffle) > shuffle


@pytest.mark.parametrize(
    "name,shuffles",
    # Shuffles after the one that removes copies.
    [("daily_summary", 3), ("retention_ndays", 2), ("funnel_steps", 2), ("ab_metrics", 2), ("sessions", 2), ("user_profile", 3)],
)
def test_number_of_shuffles(spark, name, shuffles):
    plan = plan_of(catalog.queries()[name](spark, SF))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == shuffles + 1


def test_scan_reads_only_needed_columns(spark):
    df = read_raw_events(spark, SF).filter("event_type = 'view'").select("user_id", "ts")
    plan = plan_of(df)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan
    assert "EqualTo(event_type,view)" in plan


def test_metrics_and_tests_share_one_pass(spark):
    df = catalog.queries()["ab_tested_results"](spark, SF)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_unused_columns_are_not_shuffled(spark):
    plan = plan_of(catalog.queries()["retention_ndays"](spark, SF))
    scan = plan[plan.rindex("ReadSchema") :]
    assert "value" not in scan.split(">")[0]
    assert "AS properties" not in plan and "md5" not in plan


@pytest.mark.parametrize(
    "name", ["kpi_snapshot", "top_downloads_of_day", "top_downloads", "daily_trend", "hourly_trend", "ttl_filter", "new_users_of_day", "funnel_steps_of_days"]
)
def test_days_are_filtered_before_copies_are_dropped(spark, name):
    """The day range stands below the shuffle by event id, at the scan."""
    plan = plan_of(catalog.queries()[name](spark, SF))
    below = plan[plan.index("Exchange hashpartitioning(event_id") :]
    assert re.search(r"Filter .*ts#|DataFilters: \[[^\]]*ts", below), below[:1500]


def test_kpi_reads_only_its_day_folders(spark, tmp_path):
    from footfall.plans import reports
    from footfall.sinks.tables import write_layer
    from footfall.sources.tables import read_layer

    write_layer(catalog.dwd(spark, SF), str(tmp_path), "dwd_user_behavior")
    events = read_layer(spark, str(tmp_path), "dwd_user_behavior")
    plan = plan_of(reports.kpi_snapshot(events, "2024-01-20 00:02:00"))
    assert re.search(r"PartitionFilters: \[[^\]]*2024-01-19", plan) and "2024-01-20" in plan
