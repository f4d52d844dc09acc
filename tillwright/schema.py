"""The transaction record, its derived columns, and the result tables."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------
# Field names and types of the wire record, in wire order.
RECORD = {
    "transaction_id": "string",
    "user_id": "string",
    "user_name": "string",
    "email": "string",
    "age": "int",
    "gender": "string",
    "country": "string",
    "city": "string",
    "product_id": "string",
    "product_name": "string",
    "category": "string",
    "quantity": "int",
    "price": "double",
    "payment_method": "string",
    "transaction_status": "string",
    "timestamp": "string",
}

SUCCESS = "Success"
FAILED = "Failed"
PENDING = "Pending"

# How producers write the `timestamp` field.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# The pattern text of the job this package replaces. It does not fit what producers
# write, so it yields null for their records; see README, "Event time".
LITERAL_EVENT_TIME_FORMAT = "yyyy-MM-dd %H:%M:%S"

HIGH_VALUE_THRESHOLD = 1000.0
TRIGGER_INTERVAL = "10 seconds"

# Domains of the record fields that have one: a list of values or a (low, high) range.
DOMAINS = {
    "age": (18, 70),
    "gender": ["Male", "Female", "Other"],
    "product_name": ["Laptop", "Phone", "Headphones", "Shoes", "Watch", "Tablet"],
    "category": ["Electronics", "Fashion", "Home", "Sports", "Books"],
    "quantity": (1, 5),
    "price": (10.0, 2000.0),
    "payment_method": ["Credit Card", "Debit Card", "UPI", "Net Banking", "COD"],
    "transaction_status": ["Success", "Failed", "Pending"],
}
# ----------------------------------------------------------------------------

RECORD_FIELDS = tuple(RECORD)
RECORD_DDL = ", ".join(f"`{name}` {dtype}" for name, dtype in RECORD.items())


@dataclass(frozen=True)
class Table:
    """A result table: typed columns, and the columns that identify a row."""

    columns: dict[str, str]
    key: tuple[str, ...]


# --- Fixed values: result tables, their columns and keys ---------------------
_BATCH = {"batch_id": "bigint", "batch_time": "timestamp"}

TABLES = {
    "transactions": Table(
        {
            **RECORD,
            "event_time": "timestamp",
            "transaction_value": "double",
            "processed_at": "timestamp",
        },
        ("transaction_id",),
    ),
    "transaction_metrics": Table(
        {
            **_BATCH,
            "total_transactions": "bigint",
            "successful_transactions": "bigint",
            "failed_transactions": "bigint",
            "pending_transactions": "bigint",
            "unknown_status": "bigint",
            "success_rate_percentage": "double",
            "total_revenue": "double",
            "avg_transaction_value": "double",
            "max_transaction_value": "double",
            "min_transaction_value": "double",
        },
        ("batch_id",),
    ),
    "user_metrics": Table(
        {
            **_BATCH,
            "unique_users": "bigint",
            "avg_customer_age": "double",
            "male_customers": "bigint",
            "female_customers": "bigint",
            "other_gender_customers": "bigint",
            "avg_spend_per_user": "double",
        },
        ("batch_id",),
    ),
    "category_metrics": Table(
        {
            **_BATCH,
            "category": "string",
            "order_count": "bigint",
            "category_revenue": "double",
            "avg_order_value": "double",
            "unique_products": "bigint",
            "unique_customers": "bigint",
        },
        ("batch_id", "category"),
    ),
    "payment_metrics": Table(
        {
            **_BATCH,
            "payment_method": "string",
            "transaction_count": "bigint",
            "successful_revenue": "double",
            "failed_count": "bigint",
            "success_rate": "double",
            "avg_transaction_value": "double",
        },
        ("batch_id", "payment_method"),
    ),
    "geo_metrics": Table(
        {
            **_BATCH,
            "country": "string",
            "city": "string",
            "transaction_count": "bigint",
            "revenue": "double",
            "unique_customers": "bigint",
            "avg_transaction_value": "double",
        },
        ("batch_id", "country", "city"),
    ),
    "failed_transactions": Table(
        {
            "batch_id": "bigint",
            "transaction_id": "string",
            "user_id": "string",
            "user_name": "string",
            "email": "string",
            "product_name": "string",
            "payment_method": "string",
            "transaction_value": "double",
            "country": "string",
            "city": "string",
            "event_time": "timestamp",
            "logged_at": "timestamp",
        },
        ("batch_id", "transaction_id"),
    ),
    # Keyed by batch rather than by the alert clock, so that a retry replaces its alerts.
    "high_value_alerts": Table(
        {
            "batch_id": "bigint",
            "alert_time": "timestamp",
            "transaction_id": "string",
            "user_id": "string",
            "user_name": "string",
            "product_name": "string",
            "transaction_value": "double",
            "payment_method": "string",
            "country": "string",
        },
        ("batch_id", "transaction_id"),
    ),
    "daily_aggregates": Table(
        {
            "date": "string",
            "total_transactions": "bigint",
            "total_revenue": "double",
            "avg_transaction_value": "double",
            "unique_customers": "bigint",
            "successful_transactions": "bigint",
            "failed_transactions": "bigint",
            "success_rate": "double",
            "top_category": "string",
            "top_country": "string",
            "created_at": "timestamp",
        },
        ("date",),
    ),
    "dashboard_metrics": Table(
        {
            "metric_type": "string",
            "metric_value": "double",
            "metric_text": "string",
            "last_updated": "timestamp",
        },
        ("metric_type",),
    ),
    # What a batch adds to each day: sums that add up, and a mergeable set of the users.
    "daily_state": Table(
        {
            "batch_id": "bigint",
            "day": "date",
            "category": "string",
            "country": "string",
            "n": "bigint",
            "n_success": "bigint",
            "n_failed": "bigint",
            "n_value": "bigint",
            "value": "decimal(38,8)",
            "odd_value": "double",
            "settled": "decimal(38,8)",
            "odd_settled": "double",
            "users": "binary",
        },
        ("batch_id", "day", "category", "country"),
    ),
    # What a batch has read of its source: offsets of a topic's partition, or the records of a file.
    "read_ledger": Table(
        {
            "batch_id": "bigint",
            "source": "string",
            "partition": "int",
            "from_offset": "bigint",
            "to_offset": "bigint",
            "records": "bigint",
        },
        ("batch_id", "source", "partition"),
    ),
    # The statuses seen in a batch without any success.
    # ``status_key`` is the status, or a stand-in where it is null, which a key cannot be.
    "zero_success_statuses": Table(
        {**_BATCH, "transaction_status": "string", "status_key": "string"},
        ("batch_id", "status_key"),
    ),
    # Rows that a keyed table cannot hold, as JSON, with the reason.
    "rejected_rows": Table(
        {
            "batch_id": "bigint",
            "table_name": "string",
            "reason": "string",
            "payload": "string",
            "row_hash": "string",
            "copy": "bigint",
        },
        ("batch_id", "table_name", "row_hash", "copy"),
    ),
}
# ----------------------------------------------------------------------------
