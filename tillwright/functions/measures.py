"""Column expressions shared by the metrics. All are Spark built-ins, so plans stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwright.schema import EVENT_TIME_FORMAT, SUCCESS

APPROXIMATE = "approx"
EXACT = "exact"
BOUNDED = "bounded"
DISTINCT_MODES = (APPROXIMATE, EXACT, BOUNDED)
# A group's values up to here are counted exactly in the bounded mode.
BOUNDED_VALUES_LOG2 = 12


def status_is(status: str) -> Column:
    """Case-sensitive status test; null and other spellings do not pass."""
    return F.col("transaction_status") == status


def status_is_unknown() -> Column:
    status = F.col("transaction_status")
    return status.isNull() | (status == "")


def is_high_value(threshold: float) -> Column:
    """Strictly above the threshold, whatever the status."""
    return F.col("transaction_value") > F.lit(float(threshold))


def line_value() -> Column:
    return F.col("price") * F.col("quantity")


def settled_value() -> Column:
    """The value of a Success row and 0 for every other row; null if a Success row has no value."""
    return F.when(status_is(SUCCESS), F.col("transaction_value")).otherwise(F.lit(0.0))


def half_up(number: Column, places: int) -> Column:
    """Rounded half away from zero, free of the noise of adding doubles.

    The last bits of a sum of doubles depend on the order in which tasks finish, so an average on
    a tie such as 108.135 would go up or down by chance, and a retried batch could differ from its
    first attempt. The inner rounding removes that noise.
    """
    return F.round(F.round(number, 8), places)


def cents(amount: Column) -> Column:
    """To the cent, half away from zero, for what no sum of doubles has made noisy."""
    return F.round(amount, 2)


# Money is added up in decimals, which do not depend on the order of tasks and hold cents at any size
# (doubles stop holding them near 10^14).
MONEY = "decimal(28,8)"


def exact_sum(value: Column) -> Column:
    return F.sum(value.try_cast(MONEY))


def odd_sum(value: Column) -> Column:
    """Sum of the values that no decimal holds (NaN, infinity, beyond 10^20); null if there are none."""
    return F.sum(F.when(value.try_cast(MONEY).isNull(), value))


def money(exact: Column, odd: Column, count: Column | None = None) -> Column:
    """A sum, or an average over ``count``, to the cent and as a double; odd values decide if there are any."""
    both = odd + F.coalesce(exact.cast("double"), F.lit(0.0))
    if count is not None:
        both, exact = F.try_divide(both, count), F.try_divide(exact, count)
    return F.when(odd.isNotNull(), half_up(both, 2)).otherwise(F.round(exact, 2).cast("double"))


def money_sum(value: Column) -> Column:
    return money(exact_sum(value), odd_sum(value))


def money_avg(value: Column) -> Column:
    return money(exact_sum(value), odd_sum(value), F.count(value))


def percentage(part: Column, whole: Column, places: int = 2) -> Column:
    """``part / whole`` of two counts in percent, null if ``whole`` is 0.

    Half up in integers: a rate just below a tie stays below it.
    """
    scale = 10**places
    units = F.call_function("div", part * F.lit(200 * scale) + whole, F.lit(2) * whole)
    return F.when(whole != 0, units / F.lit(float(scale)))


def distinct_values(column: str, mode: str) -> Column:
    """Distinct count of a column.

    ``approx`` is a HyperLogLog++ estimate (5 % standard error): no shuffle of the values.
    ``exact`` shuffles the distinct (group, value) pairs, spread by value, so a hot group does
    not end up in one task.
    ``bounded`` keeps a group's values as hashes up to 4,096 of them, which counts them exactly, and is a
    sketch beyond (1.6 % standard error). What it shuffles grows with a group's values, up to that
    bound: 16 bytes for a group with one value, where ``approx`` takes some 400.
    """
    if mode == APPROXIMATE:
        return F.approx_count_distinct(column)
    if mode == EXACT:
        return F.count_distinct(column)
    if mode == BOUNDED:
        return F.coalesce(F.theta_sketch_estimate(value_sketch(column)), F.lit(0).cast("long"))
    raise ValueError(f"distinct mode must be one of {', '.join(DISTINCT_MODES)}, not {mode!r}")


def value_sketch(column: str) -> Column:
    """A mergeable set of a column's values: their hashes, or a sample of these beyond the bound."""
    return F.theta_sketch_agg(column, BOUNDED_VALUES_LOG2)


def merged_count(sketches: str) -> Column:
    """The number of different values in several ``value_sketch``."""
    return F.theta_sketch_estimate(F.theta_union_agg(sketches, BOUNDED_VALUES_LOG2))


def parsed_time(text: str, pattern: str = EVENT_TIME_FORMAT) -> Column:
    """Timestamp parsed with ``pattern``; null where the text does not fit.

    Needs the parser policy that ``session.configure`` sets: under Spark's default policy even
    ``try_to_timestamp`` raises on text that only the pre-3.0 parser would have accepted.
    """
    return F.try_to_timestamp(F.col(text), F.lit(pattern))


def interval_index(time: str, width_seconds: int) -> Column:
    """Number of the fixed-width interval since the epoch that holds a timestamp."""
    micros, width = F.unix_micros(F.col(time)), F.lit(width_seconds * 1_000_000)
    # (m - m mod w) / w is floor division, also before 1970; `div` alone would truncate.
    return F.call_function("div", micros - F.pmod(micros, width), width)


def interval_start(index: str, width_seconds: int) -> Column:
    return F.timestamp_micros(F.col(index) * F.lit(width_seconds * 1_000_000))
