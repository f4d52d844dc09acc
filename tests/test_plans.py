"""The physical plans hold at scale: pruned scans, partial aggregates, no Python, no cross joins."""

import re

import pytest

from tillwright.operators import logs, metrics
from tillwright.plans.catalog import queries
from tillwright.session import scratch_folder
from tillwright.sinks.tables import FileStore
from tillwright.fixtures import tx

SF = "/root/testdata/sf0.001"

# One row over the whole table: the only plans that may end in a single partition.
GLOBAL = {
    "transaction_metrics",
    "success_rate",
    "user_metrics",
    "user_metrics_approx",
    "log_counts",
    "batch_summary",
    "status_tally",
    "domain_violations",
    "missing_fields",
    "dashboard_metrics",
    "stream_restart",
    "user_metrics_error",
    "stream_late_file",
}


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", queries())
def test_plan(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    for slow in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set"):
        assert slow not in plan
    if name not in GLOBAL:
        assert "SinglePartition" not in plan
    # Every shuffle of an aggregate is preceded by a partial one.
    if "HashAggregate" in plan and "count(1)" in plan:
        assert "partial_count(1)" in plan


@pytest.fixture(scope="module")
def stored(spark):
    store = FileStore(scratch_folder(spark, "raw"))
    store.append(tx(spark, SF), "transactions")
    return store.read(spark, "transactions")


def scan(frame):
    (line,) = [line for line in plan_of(frame).splitlines() if "FileScan" in line]
    return line


def test_filters_reach_the_scan(stored):
    assert "EqualTo(transaction_status,Failed)" in scan(logs.failed_log(stored))
    assert "GreaterThan(transaction_value,1000.0)" in scan(logs.high_value_alerts(stored))


def test_metrics_read_their_columns_only(stored):
    read = re.search(r"ReadSchema: struct<(.*?)>", scan(metrics.payment_metrics(stored)))[1]
    assert {column.split(":")[0] for column in read.split(",")} == {
        "payment_method",
        "transaction_status",
        "transaction_value",
        "_reason",  # null in all rows but rejected ones
    }


def test_exact_distinct_spreads_a_hot_group_by_value(stored):
    plan = plan_of(metrics.geo_metrics(stored, distinct="exact"))
    assert re.search(r"hashpartitioning\(country#\d+, city#\d+, user_id#\d+", plan)


def test_sample_keeps_few_rows_per_task(stored):
    assert "TakeOrderedAndProject(limit=5" in plan_of(logs.sample_records(stored))


def test_fact_join_is_a_sort_merge_join(spark):
    plan = plan_of(queries()["flatten_payload"](spark, SF))
    assert "SortMergeJoin [l_orderkey" in plan
    assert plan.count("from_json(") == 1
