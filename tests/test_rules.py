"""The rules of the metrics on hand-made rows."""

import pytest

from tillwright.operators import logs, metrics, quality
from tillwright.plans import daily, dashboard, replay
from tillwright.sources.decode import derive
from tillwright.schema import RECORD_DDL, RECORD_FIELDS


def records(spark, rows):
    blank = dict.fromkeys(RECORD_FIELDS)
    full = [tuple({**blank, **row}[name] for name in RECORD_FIELDS) for row in rows]
    return derive(spark.createDataFrame(full, RECORD_DDL))


def row(key, status, price=None, quantity=1, **more):
    return {
        "transaction_id": key,
        "transaction_status": status,
        "price": price,
        "quantity": quantity,
        "user_id": "u1",
        "timestamp": "2024-03-05 10:00:00",
        **more,
    }


@pytest.fixture(scope="module")
def tx(spark):
    return records(
        spark,
        [
            row("a", "Success", 500.0, 2, gender="Male", age=20, category="Books", payment_method="UPI"),
            row("b", "Success", 500.005, 2, gender="Female", age=31, category="Books", payment_method="UPI"),
            row("c", "Success", None, user_id="u2", category="Home", payment_method="COD", country="X", city="Y"),
            row("d", "Failed", 600.0, 2, user_id="u3", gender="Other", category="Home", payment_method="COD"),
            row("e", "Pending", 700.0, 3, user_id=None, gender="other", payment_method="COD", country="X"),
            row("f", None, 1.0, category="Home"),
            row("g", "", 2.0, city="Y"),
            row("h", "success", 4.0),
            row("i", "FAILED", 8.0),
            row(None, "Failed", 16.0, timestamp="bad"),
        ],
    )


def one(frame):
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def by(frame, *keys):
    rows = frame.collect()
    found = {tuple(r[k] for k in keys): r.asDict() for r in rows}
    assert len(found) == len(rows)
    return found


def test_transaction_metrics(tx):
    assert one(metrics.transaction_metrics(tx)) == {
        "total_transactions": 10,
        "successful_transactions": 3,
        "failed_transactions": 2,
        "pending_transactions": 1,
        "unknown_status": 2,  # null and empty; other spellings are in no bucket
        "total_revenue": 2000.01,  # a Success row without value adds nothing
        "avg_transaction_value": 592.33,  # 5331.01 over the nine rows with a value
        "max_transaction_value": 2100.0,
        "min_transaction_value": 1.0,
        "success_rate_percentage": 30.0,
    }


def test_no_rows(tx):
    empty = tx.limit(0)
    got = one(metrics.transaction_metrics(empty))
    assert {name: value for name, value in got.items() if value is not None} == {
        "total_transactions": 0,
        "successful_transactions": 0,
        "failed_transactions": 0,
        "pending_transactions": 0,
        "unknown_status": 0,
        "success_rate_percentage": 0.0,
    }
    users = one(metrics.user_metrics(empty))
    assert users["unique_users"] == 0 and users["avg_spend_per_user"] is None
    assert metrics.category_metrics(empty).count() == 0
    tally = one(quality.status_tally(empty))
    assert tally["total_sent"] == 0 and tally["success_percent"] is None


def test_revenue_without_success_is_zero_and_of_valueless_success_null(tx):
    assert one(metrics.transaction_metrics(tx.filter("transaction_id = 'f'")))["total_revenue"] == 0.0
    assert one(metrics.transaction_metrics(tx.filter("transaction_id = 'c'")))["total_revenue"] is None


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_user_metrics(tx, mode):
    assert one(metrics.user_metrics(tx, distinct=mode)) == {
        "unique_users": 3,  # the null user is none
        "avg_customer_age": 25.5,
        "male_customers": 1,
        "female_customers": 1,
        "other_gender_customers": 1,
        "avg_spend_per_user": 1777.0,
    }


def test_unknown_distinct_mode_is_refused(tx):
    with pytest.raises(ValueError, match="distinct mode"):
        metrics.user_metrics(tx, distinct="rough")


def test_category_revenue_counts_every_status(tx):
    got = by(metrics.category_metrics(tx, distinct="exact"), "category")
    assert got[("Home",)] == {
        "category": "Home",
        "order_count": 3,
        "category_revenue": 1201.0,
        "avg_order_value": 600.5,
        "unique_products": 0,
        "unique_customers": 3,
    }
    assert got[(None,)]["order_count"] == 5


def test_payment_success_is_not_having_failed(tx):
    got = by(metrics.payment_metrics(tx), "payment_method")
    assert got[("COD",)]["success_rate"] == 66.67  # a valueless Success and a Pending of three
    assert got[("COD",)]["successful_revenue"] == 0.0
    pending = one(metrics.payment_metrics(tx.filter("transaction_status = 'Pending'")))
    assert pending["success_rate"] == 100.0
    totals = one(metrics.transaction_metrics(tx.filter("transaction_status = 'Pending'")))
    assert totals["success_rate_percentage"] == 0.0


def test_geo_keeps_half_null_keys_apart(tx):
    got = by(metrics.geo_metrics(tx), "country", "city")
    assert {key: r["transaction_count"] for key, r in got.items()} == {
        ("X", "Y"): 1,
        ("X", None): 1,
        (None, "Y"): 1,
        (None, None): 7,
    }


def test_logs(tx):
    failed = logs.failed_log(tx)
    assert failed.columns == logs.FAILED_COLUMNS
    assert sorted(r["transaction_id"] or "" for r in failed.collect()) == ["", "d"]
    # Exactly 1000 is no alert; status does not matter.
    assert sorted(r["transaction_id"] for r in logs.high_value_alerts(tx).collect()) == ["b", "d", "e"]
    assert sorted(r["transaction_id"] for r in logs.high_value_alerts(tx, threshold=999).collect()) == list("abde")
    assert one(metrics.log_counts(tx)) == {"failed_logged": 2, "high_value_alerts": 3}
    assert sorted(r["transaction_id"] for r in logs.unknown_status_rows(tx).collect()) == ["f", "g"]
    assert by(metrics.status_breakdown(tx), "transaction_status")[(None,)]["count"] == 1
    assert logs.distinct_statuses(tx).count() == 7
    assert [r["transaction_id"] for r in logs.sample_records(tx, 3).collect()] == [None, "a", "b"]
    summary = one(logs.batch_summary(metrics.transaction_metrics(tx)))
    assert list(summary) == logs.SUMMARY_COLUMNS


def test_alarm_goes_by_the_rounded_rate(spark):
    def batch(number, total, status):
        other = spark.range(total - 1).selectExpr(f"{number}L as batch_id", "'Failed' as transaction_status")
        return other.union(spark.sql(f"select {number}L, '{status}'"))

    tx = batch(1, 20_001, "Success").union(batch(2, 19_999, "Success")).union(batch(3, 5, "Pending"))
    tx = tx.selectExpr("*", "cast(1 as double) as transaction_value")
    alarmed = logs.zero_success(metrics.transaction_metrics(tx, ["batch_id"]))
    assert sorted(r["batch_id"] for r in alarmed.collect()) == [1, 3]  # 0.004999... % and 0 %
    got = {tuple(r) for r in logs.zero_success_statuses(tx).collect()}
    assert got == {(1, "Success", 1), (1, "Failed", 20_000), (3, "Failed", 4), (3, "Pending", 1)}


def test_quality(tx):
    assert one(quality.status_tally(tx)) == {
        "total_sent": 10,
        "success_count": 3,
        "failed_count": 2,
        "pending_count": 5,
        "success_percent": 30.0,
        "failed_percent": 20.0,
        "pending_percent": 50.0,
    }
    violations = {r["field"]: r["violations"] for r in quality.domain_violations(tx).collect()}
    assert violations["gender"] == 1 and violations["transaction_status"] == 3 and violations["age"] == 0
    assert violations["price"] == 4 and violations["quantity"] == 0
    missing = {r["field"]: r["missing"] for r in quality.missing_fields(tx).collect()}
    assert missing["transaction_id"] == 1 and missing["price"] == 1 and missing["email"] == 10
    assert missing["any"] == 10


def test_partial_record_lacks_thirteen_fields(spark):
    tx = records(spark, [{"transaction_id": "t", "transaction_status": "Success", "timestamp": "2024-01-01 00:00:00"}])
    missing = {r["field"]: r["missing"] for r in quality.missing_fields(tx).collect()}
    assert sum(n for field, n in missing.items() if field != "any") == 13 and missing["any"] == 1


def test_interval_is_floor_division_also_before_1970(spark):
    tx = records(
        spark,
        [
            row("a", "Success", 1.0, timestamp="1969-12-31 23:59:59"),
            row("b", "Success", 1.0, timestamp="1970-01-01 00:00:00"),
            row("c", "Success", 1.0, timestamp="1970-01-01 00:00:10"),
            row("d", "Success", 1.0, timestamp=None),
        ],
    )
    got = {r["transaction_id"]: r["batch_id"] for r in replay.with_batch(tx, 10).collect()}
    assert got == {"a": -1, "b": 0, "c": 1, "d": None}
    with pytest.raises(ValueError, match="no replay"):
        replay.replay(tx, "orders", 10)


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_daily(spark, mode):
    on = {"timestamp": "2024-03-06 23:59:59"}
    tx = records(
        spark,
        [
            row("a", "Failed", 90.0, category="Books", country="P"),
            row("b", "Success", 10.0, category="Home", country="Q", user_id="u2"),
            row("c", "Success", 10.0, category=None, country="O", user_id="u2"),
            row("d", "Success", 80.0, category="Home", country=None),
            row("e", "Pending", 1.0, category=None, country=None, **on),
            row("f", "Pending", 5.0, timestamp="no time", user_id=None),
        ],
    )
    got = by(daily.daily_aggregates(tx, mode), "date")
    assert got[("2024-03-05",)] == {
        "date": "2024-03-05",
        "total_transactions": 4,
        "total_revenue": 100.0,
        "avg_transaction_value": 47.5,
        "successful_transactions": 3,
        "failed_transactions": 1,
        "success_rate": 75.0,
        "top_category": "Books",  # 90 both, the first by name, over all statuses
        "top_country": "O",  # 10 both, of successful rows; the 80 have no country
        "unique_customers": 2,
    }
    assert got[("2024-03-06",)]["top_category"] is None and got[("2024-03-06",)]["top_country"] is None
    assert got[(None,)]["total_transactions"] == 1 and got[(None,)]["unique_customers"] == 0
    top = by(daily.top_category(tx), "date")
    assert top[("2024-03-05",)]["top_category"] == "Books" and top[("2024-03-06",)]["top_category"] is None
    assert by(daily.top_country(tx), "date")[("2024-03-05",)]["top_country"] == "O"


def test_dashboard(tx):
    got = by(dashboard.dashboard_metrics(metrics.transaction_metrics(tx)), "metric_type")
    assert len(got) == 10
    assert got[("total_transactions",)]["metric_text"] == "10"
    assert got[("success_rate_percentage",)]["metric_text"] == "30.00%"
    assert got[("total_revenue",)]["metric_value"] == 2000.01
    empty = by(dashboard.dashboard_metrics(metrics.transaction_metrics(tx.limit(0))), "metric_type")
    assert empty[("total_revenue",)]["metric_text"] is None


def test_dashboard_latest_takes_the_newest_batch(spark):
    tx = records(
        spark,
        [row("a", "Success", 7.0), row("b", "Failed", 9.0, timestamp="2024-03-06 10:00:00")],
    )
    rows = replay.replay(tx, "transaction_metrics", 86_400)
    got = by(dashboard.dashboard_latest(rows), "metric_type")
    assert got[("total_revenue",)]["metric_value"] == 0.0
    assert str(got[("max_transaction_value",)]["last_updated"]) == "2024-03-06 00:00:00"
