"""Replay of stored transactions in batches of fixed event-time width.

A stream forms its batches by arrival. On stored data the same tables come from one job per table,
with the batch as an extra grouping key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwright.functions.measures import APPROXIMATE, interval_index, interval_start
from tillwright.operators import logs, metrics
from tillwright.schema import HIGH_VALUE_THRESHOLD

BATCH = ("batch_id",)


def with_batch(tx: DataFrame, width_seconds: int, time: str = "event_time") -> DataFrame:
    """Add ``batch_id``, the interval of the event time. Without an event time it is null."""
    return tx.withColumn("batch_id", interval_index(time, width_seconds))


def with_batch_time(rows: DataFrame, width_seconds: int) -> DataFrame:
    """Add ``batch_time``, the start of the interval; a replay has no clock of its own."""
    return rows.withColumn("batch_time", interval_start("batch_id", width_seconds))


# The result tables a replay makes, with whether they carry the batch time.
REPLAYED = {
    "transaction_metrics": True,
    "user_metrics": True,
    "category_metrics": True,
    "payment_metrics": True,
    "geo_metrics": True,
    "failed_transactions": False,
    "high_value_alerts": False,
}


def replay(
    tx: DataFrame,
    table: str,
    width_seconds: int,
    distinct: str = APPROXIMATE,
    threshold: float = HIGH_VALUE_THRESHOLD,
) -> DataFrame:
    """One result table by ``batch_id``, as a plan that reads the columns of this table only."""
    batches = with_batch(tx, width_seconds)
    match table:
        case "transaction_metrics":
            rows = metrics.transaction_metrics(batches, BATCH)
        case "user_metrics":
            rows = metrics.user_metrics(batches, BATCH, distinct)
        case "category_metrics":
            rows = metrics.category_metrics(batches, BATCH, distinct)
        case "payment_metrics":
            rows = metrics.payment_metrics(batches, BATCH)
        case "geo_metrics":
            rows = metrics.geo_metrics(batches, BATCH, distinct)
        case "failed_transactions":
            rows = logs.failed_log(batches, BATCH)
        case "high_value_alerts":
            rows = logs.high_value_alerts(batches, BATCH, threshold)
        case _:
            raise ValueError(f"no replay makes the table {table!r}; there are {', '.join(REPLAYED)}")
    return with_batch_time(rows, width_seconds) if REPLAYED[table] else rows
