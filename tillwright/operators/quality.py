"""Checks on the records themselves: status tally, domains, missing fields. One pass each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.functions.measures import percentage, status_is
from tillwright.schema import DOMAINS, FAILED, RECORD_FIELDS, SUCCESS


def status_tally(tx: DataFrame) -> DataFrame:
    """Counts and shares to one decimal; whatever is neither Success nor Failed is pending."""
    counts = tx.agg(
        F.count(F.lit(1)).alias("total_sent"),
        F.count_if(status_is(SUCCESS)).alias("success_count"),
        F.count_if(status_is(FAILED)).alias("failed_count"),
    ).withColumn("pending_count", F.expr("total_sent - success_count - failed_count"))
    total = F.col("total_sent")
    return counts.withColumns(
        {
            f"{name}_percent": percentage(F.col(f"{name}_count"), total, places=1)
            for name in ("success", "failed", "pending")
        }
    )


def _outside(field: str, domain: Sequence) -> Column:
    if isinstance(domain, tuple):
        low, high = domain
        return ~F.col(field).between(low, high)
    return ~F.col(field).isin(list(domain))


def domain_violations(tx: DataFrame, domains: Mapping[str, Sequence] = DOMAINS) -> DataFrame:
    """Per field with a domain, the rows outside it. A null is missing, not outside."""
    counts = tx.agg(*[F.count_if(_outside(field, domain)).alias(field) for field, domain in domains.items()])
    return counts.unpivot([], list(domains), "field", "violations")


def missing_fields(tx: DataFrame, fields: Sequence[str] = RECORD_FIELDS) -> DataFrame:
    """Per field the rows that lack it, and as field ``any`` the incomplete records."""
    incomplete = F.lit(False)
    for field in fields:
        incomplete = incomplete | F.col(field).isNull()
    counts = tx.agg(
        *[F.count_if(F.col(field).isNull()).alias(field) for field in fields],
        F.count_if(incomplete).alias("any"),
    )
    return counts.unpivot([], [*fields, "any"], "field", "missing")
