"""What several operators of this package need: words, shared tables, hot-group safe numbering."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.session import scratch_folder

# White space is space and the ASCII controls tab to carriage return, nothing else.
SPACES = " \t\n\v\f\r"
WORD = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch are handled in slices of about so many bytes, so that a batch of very
# long texts does not multiply its size in Python objects.
SLICE_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_folder(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def discard(*frames: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, once nothing reads them any more."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes (one row at least)."""
    for batch in batches:
        start, held = 0, batch.num_rows
        step = max(1, held if not batch.nbytes else int(held * most / batch.nbytes))
        while start < held:
            yield batch.slice(start, step)
            start += step


def numbered(
    df: DataFrame, group: list[str], order: list[str], weight: Column, name: str, salts: int, ties: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows of the same group that come before.

    The order is by a hash of ``order`` into ``salts`` parts, then by ``order``. A group that holds
    most rows is spread over its parts: part sums are aggregated first, and only they are summed up
    per group. The numbers are gapless and the same in each run, if ``order`` and ``ties``, which come after
    it, tell rows apart.
    """
    salt = F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int")
    salted = df.withColumn("_salt", salt).withColumn("_weight", weight.cast("long"))
    parts = salted.groupBy(*group, "_salt").agg(F.sum("_weight").alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    renamed = [F.col(c).alias(f"_g{i}") for i, c in enumerate(group)]
    offsets = parts.select(
        *renamed,
        F.col("_salt").alias("_part"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"),
    )
    same = F.col("_salt") == F.col("_part")
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    within = (
        Window.partitionBy(*group, "_salt")
        .orderBy(*order, *ties)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = salted.withColumn("_inside", F.coalesce(F.sum("_weight").over(within), F.lit(0)))
    found = inside.join(offsets, same).withColumn(name, F.col("_offset") + F.col("_inside"))
    return found.drop("_salt", "_weight", "_inside", "_part", "_offset", *[f"_g{i}" for i in range(len(group))])
