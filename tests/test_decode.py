"""From record text to transactions."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException

from tillwright.schema import LITERAL_EVENT_TIME_FORMAT, RECORD_DDL, RECORD_FIELDS
from tillwright.sinks.publish import to_json_records
from tillwright.sources import decode

GOOD = {"transaction_id": "t", "quantity": 3, "price": 2.5, "timestamp": "2024-03-05 12:30:45"}


def decoded(spark, texts):
    raw = spark.createDataFrame([(text.encode() if text is not None else None,) for text in texts], "value binary")
    return decode.decode_transactions(raw).collect()


@pytest.mark.parametrize("text", ["{bad", json.dumps(GOOD)[:-5], "[]", "", None, "null", "7"])
def test_text_that_is_no_record_is_kept_as_nulls(spark, text):
    (row,) = decoded(spark, [text])
    assert all(row[name] is None for name in (*RECORD_FIELDS, "event_time", "transaction_value"))
    assert row["processed_at"] is not None


def test_record(spark):
    (row,) = decoded(spark, [json.dumps({**GOOD, "test": True})])
    assert row["transaction_value"] == 7.5
    assert row["event_time"] == dt.datetime(2024, 3, 5, 12, 30, 45)
    assert row["user_id"] is None and "test" not in row.asDict()


@pytest.mark.parametrize(
    "field, value", [("quantity", "3"), ("quantity", 2.5), ("price", "x"), ("age", True)]
)
def test_mistyped_field_is_null_and_the_others_are_not(spark, field, value):
    (row,) = decoded(spark, [json.dumps({**GOOD, field: value})])
    assert row[field] is None and row["transaction_id"] == "t"
    if field != "age":
        assert row["transaction_value"] is None


def test_number_in_a_text_field_is_its_text(spark):
    (row,) = decoded(spark, [json.dumps({**GOOD, "user_id": 17})])
    assert row["user_id"] == "17"


@pytest.mark.parametrize(
    "text", ["bad", "2024-1-1 0:0:0", "2024-01-01T00:00:00", "2024-02-30 10:00:00", "2024-01-01 25:00:00", "", None]
)
def test_unparseable_time_is_null(spark, text):
    (row,) = decoded(spark, [json.dumps({**GOOD, "timestamp": text})])
    assert row["event_time"] is None and row["timestamp"] == text


def test_literal_pattern_does_not_fit_what_producers_write(spark):
    rows = spark.createDataFrame([("2024-03-05 12:30:45", 1.0, 1)], "timestamp string, price double, quantity int")
    assert decode.derive(rows).first()["event_time"] is not None
    assert decode.derive(rows, LITERAL_EVENT_TIME_FORMAT).first()["event_time"] is None


def test_the_default_parser_policy_would_raise(spark):
    """Why ``session.configure`` sets another one."""
    rows = spark.createDataFrame([("2024-1-1 0:0:0", 1.0, 1)], "timestamp string, price double, quantity int")
    policy = "spark.sql.legacy.timeParserPolicy"
    spark.conf.set(policy, "EXCEPTION")
    try:
        with pytest.raises(PySparkException):
            decode.derive(rows).collect()
    finally:
        spark.conf.set(policy, "CORRECTED")


def test_published_records_come_back(spark):
    rows = [
        ("t1", "u", "Zoë \"Z\"", "a@b", 20, None, "C\n", "d", "p", "n", "c", 2, 0.1, "UPI", "", "2024-01-01 00:00:00"),
        (None,) * 16,
    ]
    tx = spark.createDataFrame(rows, RECORD_DDL)
    published = to_json_records(tx)
    assert set(json.loads(published.first()["value"])) == set(RECORD_FIELDS)
    back = decode.decode_transactions(published).select(*RECORD_FIELDS).collect()
    assert {tuple(row) for row in back} == set(rows)


def test_not_a_number_is_a_number_here(spark):
    (row,) = decoded(spark, ['{"transaction_id":"n","price":NaN,"quantity":1}'])
    assert row["transaction_id"] == "n" and row["transaction_value"] != row["transaction_value"]
