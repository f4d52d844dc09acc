"""Daily rollup from transactions, not from batch metrics: those are rounded and their distinct
counts do not add up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.measures import (
    BOUNDED,
    distinct_values,
    exact_sum,
    merged_count,
    money,
    odd_sum,
    percentage,
    settled_value,
    status_is,
    value_sketch,
)
from tillwright.schema import FAILED, SUCCESS

_SUMS = ("n", "n_success", "n_failed", "n_value", "value", "odd_value", "settled", "odd_settled")


def _day() -> Column:
    return F.to_date("event_time").alias("day")


def _date_text(rows: DataFrame) -> DataFrame:
    others = [name for name in rows.columns if name != "day"]
    return rows.select(F.col("day").cast("string").alias("date"), *others)


def daily_state(tx: DataFrame, keys: Sequence[str] = (), users: bool = True) -> DataFrame:
    """What rows add to their days, per (day, category, country): the one pass over the rows.

    States of several batches, one after another or stored with ``keys=("batch_id",)``, merge into the days of
    all their rows in ``from_state``. So a late batch corrects its days without the rows of others, and
    a batch that is done again replaces its state.
    """
    sketch = [value_sketch("user_id").alias("users")] if users else []
    return tx.groupBy(*keys, _day(), "category", "country").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(status_is(SUCCESS)).alias("n_success"),
        F.count_if(status_is(FAILED)).alias("n_failed"),
        F.count("transaction_value").alias("n_value"),
        exact_sum(F.col("transaction_value")).alias("value"),
        odd_sum(F.col("transaction_value")).alias("odd_value"),
        exact_sum(settled_value()).alias("settled"),
        odd_sum(settled_value()).alias("odd_settled"),
        *sketch,
    )


def _top(name: str, revenue: str, level: Column) -> Column:
    """The name with the highest revenue to the cent among rows of one grouping level, ties by name."""
    earned = money(F.col(revenue), F.col(f"odd_{revenue}"))
    rank = F.struct((-earned).alias("less"), F.col(name).alias("name"))
    # A null name is no key of the metric tables and a null revenue is no revenue: neither ranks.
    ranked = F.when(level & F.col(name).isNotNull() & earned.isNotNull(), rank)
    return F.min(ranked)["name"]


def daily_aggregates(tx: DataFrame, distinct: str = BOUNDED) -> DataFrame:
    """One row per day with totals, rates, distinct customers, top category and top country.

    The rows shrink to (day, category, country) before the first shuffle, and all else is made of that
    small table. In the other modes than ``bounded``, customers are counted in an aggregate of their
    own, which reads two columns: their counts do not add up from a finer grain.
    """
    if distinct == BOUNDED:
        return from_state(daily_state(tx))
    days = _days(daily_state(tx, users=False))
    users = tx.groupBy(_day().alias("user_day")).agg(
        distinct_values("user_id", distinct).alias("unique_customers")
    )
    # Rows without an event time form a day of their own, as null.
    return _date_text(days.join(users, F.col("day").eqNullSafe(F.col("user_day"))).drop("user_day"))


def from_state(state: DataFrame) -> DataFrame:
    """``daily_aggregates`` of all rows whose ``daily_state`` is given, in one state or many."""
    return _date_text(_days(state, [merged_count("users").alias("users")]).withColumnRenamed("users", "unique_customers"))


def _days(state: DataFrame, merged: Sequence[Column] = ()) -> DataFrame:
    """One row per day; the three levels that it needs are grouping sets over the state."""
    day, category, country = F.col("day"), F.col("category"), F.col("country")
    levels = state.groupingSets([[day], [day, category], [day, country]], day, category, country).agg(
        *[F.sum(n).alias(n) for n in _SUMS],
        *merged,
        F.grouping("category").alias("no_category"),
        F.grouping("country").alias("no_country"),
    )
    whole = (F.col("no_category") == 1) & (F.col("no_country") == 1)
    by_category, by_country = F.col("no_category") == 0, F.col("no_country") == 0

    def total(name: str) -> Column:
        return F.max(F.when(whole, F.col(name)))

    return levels.groupBy("day").agg(
        total("n").alias("total_transactions"),
        money(total("settled"), total("odd_settled")).alias("total_revenue"),
        money(total("value"), total("odd_value"), total("n_value")).alias("avg_transaction_value"),
        total("n_success").alias("successful_transactions"),
        total("n_failed").alias("failed_transactions"),
        percentage(total("n_success"), total("n")).alias("success_rate"),
        _top("category", "value", by_category).alias("top_category"),
        _top("country", "settled", by_country).alias("top_country"),
        *[total("users").alias("users")] * bool(merged),
    )


def days_of(state: DataFrame, touched: DataFrame) -> DataFrame:
    """The state of the days that occur in ``touched`` (column day), null day included."""
    days = touched.select(F.col("day").alias("_day")).distinct()
    return state.join(days, F.col("day").eqNullSafe(F.col("_day")), "left_semi")


def top_category(tx: DataFrame) -> DataFrame:
    """Per day the category with the highest revenue over all statuses, ties by name."""
    return _top_of(tx, "category", F.col("transaction_value"), "top_category")


def top_country(tx: DataFrame) -> DataFrame:
    """Per day the country with the highest revenue of successful rows, ties by name."""
    return _top_of(tx, "country", settled_value(), "top_country")


def _top_of(tx: DataFrame, name: str, revenue: Column, alias: str) -> DataFrame:
    sums = tx.groupBy(_day(), name).agg(
        exact_sum(revenue).alias("revenue"), odd_sum(revenue).alias("odd_revenue")
    )
    return _date_text(sums.groupBy("day").agg(_top(name, "revenue", F.lit(True)).alias(alias)))


def user_sketches(batches: DataFrame) -> DataFrame:
    """One mergeable sketch of the users per day and batch."""
    return batches.groupBy(_day(), "batch_id").agg(F.hll_sketch_agg("user_id").alias("users"))


def merged_unique_customers(sketches: DataFrame) -> DataFrame:
    """Distinct customers per day out of the batch sketches, without the rows."""
    union = F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_customers")
    return _date_text(sketches.groupBy("day").agg(union))
