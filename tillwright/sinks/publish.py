"""Transactions out as JSON records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.schema import RECORD_FIELDS


def to_json_records(tx: DataFrame, fields: Sequence[str] = RECORD_FIELDS) -> DataFrame:
    """One JSON object per row in ``value``, null fields written as null."""
    record = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return tx.select(record.alias("value"))


def publish_folder(records: DataFrame, path: str, max_records_per_file: int = 1_000_000) -> None:
    """Append JSON-lines files of bounded size, compressed and written by the tasks in parallel."""
    writer = records.select("value").write.mode("append").option("maxRecordsPerFile", max_records_per_file)
    writer.text(path, compression="gzip")


def publish_topic(
    records: DataFrame, servers: str, topic: str, options: Mapping[str, str] | None = None
) -> None:
    """Send to a Kafka topic (needs Spark's Kafka package on the classpath)."""
    (
        records.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**dict(options or {}))
        .save()
    )
