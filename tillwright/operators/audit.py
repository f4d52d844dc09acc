"""What each batch has read of its source, and whether anything was lost or read twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def read_ledger(batch: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """source, partition, from_offset, to_offset (exclusive) and records of one batch with its places.

    Of a file, the range is that of its records by number.
    """
    ranges = batch.groupBy(*keys, F.col("_source").alias("source"), F.col("_partition").alias("partition")).agg(
        F.min("_offset").alias("_first"), F.max("_offset").alias("_last"), F.count(F.lit(1)).alias("records")
    )
    return ranges.select(
        *keys,
        "source",
        "partition",
        F.coalesce("_first", F.lit(0)).cast("long").alias("from_offset"),
        F.coalesce(F.col("_last") + 1, "records").alias("to_offset"),
        "records",
    )


def offset_faults(ledger: DataFrame) -> DataFrame:
    """The ranges of offsets that no batch has read, or more than one, per source and partition.

    Columns source, partition, fault (``lost`` or ``doubled``), from_offset, to_offset (exclusive), batch_id (the
    batch whose range shows it). Ranges go by their start; each is compared with the farthest end of those before it, so nested and repeated
    ranges are found too. Nothing tells what came before the first range. A lost range in a compacted topic may be no loss.
    """
    by_start = Window.partitionBy("source", "partition").orderBy("from_offset", "to_offset", "batch_id")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ledger.withColumn("_end", F.max("to_offset").over(before))
    start = F.col("from_offset")
    lost = F.when(start > F.col("_end"), F.struct(F.lit("lost").alias("fault"), F.col("_end").alias("low"), start.alias("high")))
    shared = F.least("to_offset", "_end")
    doubled = F.when(start < shared, F.struct(F.lit("doubled").alias("fault"), start.alias("low"), shared.alias("high")))
    found = ranges.filter("_end IS NOT NULL").withColumn("_fault", F.coalesce(lost, doubled)).filter("_fault IS NOT NULL")
    return found.select(
        "source", "partition", "_fault.fault", F.col("_fault.low").alias("from_offset"), F.col("_fault.high").alias("to_offset"), "batch_id"
    )
