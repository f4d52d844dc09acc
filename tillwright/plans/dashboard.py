"""Metrics as (metric_type, metric_value, metric_text) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.operators.keyed import latest_by_key

# How each metric reads as text.
_FORMATS = {
    "total_transactions": "%.0f",
    "successful_transactions": "%.0f",
    "failed_transactions": "%.0f",
    "pending_transactions": "%.0f",
    "unknown_status": "%.0f",
    "success_rate_percentage": "%.2f%%",
    "total_revenue": "%.2f",
    "avg_transaction_value": "%.2f",
    "max_transaction_value": "%.2f",
    "min_transaction_value": "%.2f",
}


def dashboard_metrics(metrics: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """One row per metric of each metrics row; ``ids`` are carried along."""
    numbers = metrics.select(*ids, *[F.col(name).cast("double").alias(name) for name in _FORMATS])
    rows = numbers.unpivot(list(ids), list(_FORMATS), "metric_type", "metric_value")
    text = F.lit(None).cast("string")
    for name, pattern in _FORMATS.items():
        shown = F.format_string(pattern, F.col("metric_value"))
        text = F.when(F.col("metric_type") == name, shown).otherwise(text)
    return rows.withColumn("metric_text", F.when(F.col("metric_value").isNotNull(), text))


def dashboard_latest(metrics: DataFrame) -> DataFrame:
    """The newest value of each metric over all batches (needs ``batch_id`` and ``batch_time``)."""
    rows = dashboard_metrics(metrics, ids=("batch_id", "batch_time"))
    newest = latest_by_key(rows, key=["metric_type"], version=["batch_id"])
    return newest.select(
        "metric_type", "metric_value", "metric_text", F.col("batch_time").alias("last_updated")
    )
