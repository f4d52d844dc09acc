"""Row logs, samples, the batch summary and the zero-success alarm."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions.measures import is_high_value, status_is, status_is_unknown
from tillwright.operators.metrics import status_breakdown, success_rate
from tillwright.schema import FAILED, HIGH_VALUE_THRESHOLD, SUCCESS

# --- Fixed values: columns of the logs and of the summary, in order ----------
FAILED_COLUMNS = [
    "transaction_id",
    "user_id",
    "user_name",
    "email",
    "product_name",
    "payment_method",
    "transaction_value",
    "country",
    "city",
    "event_time",
]
ALERT_COLUMNS = [
    "transaction_id",
    "user_id",
    "user_name",
    "product_name",
    "transaction_value",
    "payment_method",
    "country",
]
SUMMARY_COLUMNS = [
    "total_transactions",
    "successful_transactions",
    "failed_transactions",
    "pending_transactions",
    "unknown_status",
    "success_rate_percentage",
    "total_revenue",
    "avg_transaction_value",
]
# ----------------------------------------------------------------------------


def failed_log(tx: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return tx.filter(status_is(FAILED)).select(*keys, *FAILED_COLUMNS)


def high_value_alerts(
    tx: DataFrame, keys: Sequence[str] = (), threshold: float = HIGH_VALUE_THRESHOLD
) -> DataFrame:
    """Rows above the threshold. Expect most rows of a busy shop, not a handful."""
    return tx.filter(is_high_value(threshold)).select(*keys, *ALERT_COLUMNS)


def unknown_status_rows(tx: DataFrame) -> DataFrame:
    return tx.filter(status_is_unknown())


def sample_records(tx: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows by id; each task keeps ``n`` rows, so nothing is sorted globally."""
    sample = tx.select("transaction_id", "transaction_status", "transaction_value")
    return sample.orderBy("transaction_id").limit(n)


def distinct_statuses(tx: DataFrame) -> DataFrame:
    return tx.select("transaction_status").distinct()


def alarmed_statuses(tx: DataFrame) -> DataFrame:
    """The statuses of an alarmed batch, with the key under which a null is stored."""
    status = F.col("transaction_status")
    stand_in = F.when(status.isNull(), "null").otherwise(F.concat(F.lit("="), status))
    return distinct_statuses(tx).withColumn("status_key", stand_in)


def batch_summary(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return metrics.select(*keys, *SUMMARY_COLUMNS)


def zero_success(metrics: DataFrame) -> DataFrame:
    """Metric rows whose *rounded* success rate is 0, which is below 0.005 %."""
    return metrics.filter(F.col("success_rate_percentage") == 0.0)


def zero_success_statuses(tx: DataFrame, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    """The statuses of each alarmed batch with their row counts, for all batches in one job.

    Rows are reduced to one per (batch, status) first, so what the semi join moves does not grow
    with the rows of a batch. Both its sides start from this same aggregate, counts included, so
    the rows are read and shuffled once.
    """
    statuses = status_breakdown(tx, keys)
    totals = statuses.groupBy(*keys).agg(
        F.sum("count").alias("total_transactions"),
        F.sum(F.when(status_is(SUCCESS), F.col("count")).otherwise(0)).alias("successful_transactions"),
    )
    alarmed = zero_success(totals.withColumn("success_rate_percentage", success_rate()))
    # Null-safe: records without an event time have a null batch, which can be alarmed too.
    alarmed = alarmed.select(*[F.col(key).alias(f"_{key}") for key in keys])
    same = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return statuses.join(alarmed, same, "left_semi")
