"""Keyed-table semantics: latest row per key, rejection of null keys, clustering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(
    rows: DataFrame,
    key: Sequence[str],
    version: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key, the one with the highest version.

    ``version`` should order the rows of a key totally. The aggregate keeps one row per key and
    task before the shuffle, so a key with very many versions is no hot spot. Name the ``columns``
    you need: the kept row travels whole.
    """
    columns = list(columns or rows.columns)
    newest = F.max_by(F.struct(*columns), F.struct(*version)).alias("newest")
    return rows.groupBy(*[F.col(name).alias(f"_key_{name}") for name in key]).agg(newest).select("newest.*")


def has_whole_key(key: Sequence[str]) -> Column:
    whole = F.lit(True)
    for name in key:
        whole = whole & F.col(name).isNotNull()
    return whole


def split_on_key(rows: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows a keyed table can hold, and the others with a ``reason`` naming the null key columns."""
    missing = F.concat_ws(", ", *[F.when(F.col(name).isNull(), F.lit(name)) for name in key])
    rejected = rows.filter(~has_whole_key(key)).withColumn("reason", F.concat(F.lit("null key: "), missing))
    return rows.filter(has_whole_key(key)), rejected


def clustered(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows sorted by ``key`` within partitions that hold disjoint key ranges.

    Ranges over the whole key, not a hash of its first column: one large batch is then spread over
    several tasks, each writing a sorted run of it.
    """
    return rows.repartitionByRange(*key).sortWithinPartitions(*key)
