"""Every registered query against its SQL equivalent, and what has none against its exact twin."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.parity import database, differences
from tillwright.plans import catalog, oracle

SF = "/root/testdata/sf0.01"

# Without SQL equivalent: (columns that identify a row, estimated columns, the exact query).
SKETCHES = {
    "user_metrics_approx": ([], ["unique_users"], "user_metrics"),
    "category_metrics_approx": (["category"], ["unique_products", "unique_customers"], "category_metrics"),
    "geo_metrics_approx": (["country", "city"], ["unique_customers"], "geo_metrics"),
    "daily_aggregates_approx": (["date"], ["unique_customers"], "daily_aggregates"),
}


@pytest.fixture(scope="module")
def connection():
    return database(SF)


@pytest.mark.parametrize("name", oracle_sql())
def test_same_as_sql(spark, connection, name):
    assert differences(queries()[name](spark, SF), connection, oracle_sql()[name]) == []


@pytest.mark.parametrize("name", SKETCHES)
def test_sketch_is_near_exact(spark, name):
    keys, estimates, twin = SKETCHES[name]
    rough = {tuple(r[k] for k in keys): r for r in queries()[name](spark, SF).collect()}
    exact = {tuple(r[k] for k in keys): r for r in queries()[twin](spark, SF).collect()}
    assert rough.keys() == exact.keys()
    for key, row in exact.items():
        for column in estimates:
            # Three standard errors of 5 %, and one for rounding.
            assert abs(rough[key][column] - row[column]) <= 0.15 * row[column] + 1
        for column in set(row.asDict()) - set(estimates) - {"avg_spend_per_user"}:
            assert rough[key][column] == row[column]


def test_merged_sketches_are_near_exact(spark):
    from tillwright.fixtures import event_tx
    from tillwright.plans.daily import daily_aggregates

    merged = {r["date"]: r["unique_customers"] for r in queries()["daily_unique_merged"](spark, SF).collect()}
    exact = daily_aggregates(event_tx(spark, SF), "exact").collect()
    assert merged.keys() == {r["date"] for r in exact}
    for row in exact:
        assert abs(merged[row["date"]] - row["unique_customers"]) <= 0.05 * row["unique_customers"]


def test_every_query_is_checked():
    assert set(catalog.queries()) == set(oracle.oracle_sql()) | set(SKETCHES) | {"daily_unique_merged"}
    assert set(catalog.queries()) <= set(queries()) and set(oracle.oracle_sql()) <= set(oracle_sql())


def test_entry_has_one_row(spark):
    rows = entry(spark).collect()
    assert len(rows) == 1 and rows[0]["total_transactions"] > 0
