"""The metric tables as pure functions of transactions.

Each takes ``keys``, extra grouping columns: none for one static table, ``("batch_id",)`` for a
replay of many batches, and none again inside a stream's micro-batch, which is one batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.measures import (
    APPROXIMATE,
    BOUNDED,
    cents,
    distinct_values,
    exact_sum,
    is_high_value,
    money,
    money_avg,
    money_sum,
    odd_sum,
    percentage,
    settled_value,
    status_is,
    status_is_unknown,
)
from tillwright.schema import FAILED, HIGH_VALUE_THRESHOLD, PENDING, SUCCESS


def transaction_metrics(
    tx: DataFrame, keys: Sequence[str] = (), extra: Sequence[Column] = ()
) -> DataFrame:
    """Counts per status, revenue of successful rows, and value statistics over all rows.

    A status outside the four buckets counts in the total only. ``extra`` aggregates ride along in
    the same pass.
    """
    totals = tx.groupBy(*keys).agg(*[column.alias(name) for name, column in total_columns().items()], *extra)
    return totals.withColumn("success_rate_percentage", success_rate())


def total_columns() -> dict[str, Column]:
    """The aggregates of ``transaction_metrics``, which a stream can also observe on its way."""
    value = F.col("transaction_value")
    return {
        "total_transactions": F.count(F.lit(1)),
        "successful_transactions": F.count_if(status_is(SUCCESS)),
        "failed_transactions": F.count_if(status_is(FAILED)),
        "pending_transactions": F.count_if(status_is(PENDING)),
        "unknown_status": F.count_if(status_is_unknown()),
        "total_revenue": money_sum(settled_value()),
        "avg_transaction_value": money_avg(value),
        "max_transaction_value": cents(F.max(value)),
        "min_transaction_value": cents(F.min(value)),
    }


def success_rate():
    """Share of Success rows in percent, 0 for no rows; reads the columns of the metrics."""
    rate = percentage(F.col("successful_transactions"), F.col("total_transactions"))
    return F.coalesce(rate, F.lit(0.0))


def user_metrics(tx: DataFrame, keys: Sequence[str] = (), distinct: str = APPROXIMATE) -> DataFrame:
    """Distinct users and spend per user; age and gender are counted per row, not per user."""
    stats = tx.groupBy(*keys).agg(
        distinct_values("user_id", distinct).alias("unique_users"),
        cents(F.avg("age")).alias("avg_customer_age"),
        F.count_if(F.col("gender") == "Male").alias("male_customers"),
        F.count_if(F.col("gender") == "Female").alias("female_customers"),
        F.count_if(F.col("gender") == "Other").alias("other_gender_customers"),
        exact_sum(F.col("transaction_value")).alias("spend"),
        odd_sum(F.col("transaction_value")).alias("odd_spend"),
    )
    per_user = money(F.col("spend"), F.col("odd_spend"), F.col("unique_users"))
    return stats.withColumn("avg_spend_per_user", per_user).drop("spend", "odd_spend")


def category_metrics(tx: DataFrame, keys: Sequence[str] = (), distinct: str = APPROXIMATE) -> DataFrame:
    """Orders, revenue of all statuses, and distinct products and customers per category."""
    return tx.groupBy(*keys, "category").agg(
        F.count(F.lit(1)).alias("order_count"),
        money_sum(F.col("transaction_value")).alias("category_revenue"),
        money_avg(F.col("transaction_value")).alias("avg_order_value"),
        distinct_values("product_id", distinct).alias("unique_products"),
        distinct_values("user_id", distinct).alias("unique_customers"),
    )


def payment_metrics(tx: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts and revenue of successful rows per payment method.

    Its success rate is the share of rows that did not fail, so Pending and unknown rows count as
    success here, unlike in ``transaction_metrics``.
    """
    stats = tx.groupBy(*keys, "payment_method").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        money_sum(settled_value()).alias("successful_revenue"),
        F.count_if(status_is(FAILED)).alias("failed_count"),
        money_avg(F.col("transaction_value")).alias("avg_transaction_value"),
    )
    not_failed = F.col("transaction_count") - F.col("failed_count")
    return stats.withColumn("success_rate", percentage(not_failed, F.col("transaction_count")))


def geo_metrics(tx: DataFrame, keys: Sequence[str] = (), distinct: str = BOUNDED) -> DataFrame:
    """Counts, revenue of successful rows and distinct customers per country and city.

    Nearly every row may be its own (country, city), so the mode is one whose state is as small as
    its group.
    """
    return tx.groupBy(*keys, "country", "city").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        money_sum(settled_value()).alias("revenue"),
        distinct_values("user_id", distinct).alias("unique_customers"),
        money_avg(F.col("transaction_value")).alias("avg_transaction_value"),
    )


def log_counts(tx: DataFrame, keys: Sequence[str] = (), threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """How many rows the failure log and the alerts get, without building either."""
    return tx.groupBy(*keys).agg(*log_count_columns(threshold))


LOG_COUNTS = ("failed_logged", "high_value_alerts")


def log_count_columns(threshold: float = HIGH_VALUE_THRESHOLD) -> list[Column]:
    counted = (status_is(FAILED), is_high_value(threshold))
    return [F.count_if(test).alias(name) for test, name in zip(counted, LOG_COUNTS, strict=True)]


def status_breakdown(tx: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per status; null is a group of its own."""
    return tx.groupBy(*keys, "transaction_status").agg(F.count(F.lit(1)).alias("count"))
