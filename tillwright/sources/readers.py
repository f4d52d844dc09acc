"""Where raw records come from. Every reader gives a table or stream with a ``value`` column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def topic_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A Kafka topic as an unbounded table (needs Spark's Kafka package on the classpath).

    ``starting_offsets`` matters on the first start only; a restart goes on from its checkpoint.
    ``min_partitions`` splits topic partitions over more tasks than the topic has partitions, and
    ``max_offsets_per_trigger`` bounds a micro-batch after a long stop.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**dict(options or {}))
    )
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


# Older than any file: no file is left out for its modification time.
ANY_AGE = "36500d"


def folder_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    max_file_age: str = ANY_AGE,
    archive_dir: str | None = None,
) -> DataFrame:
    """A folder of JSON-lines files as an unbounded table; new files are new records.

    Spark by itself ignores files more than a week older than the newest one, so records of a
    backfill or of a copy that keeps times would be lost. Here every file counts, unless
    ``max_file_age`` says otherwise. Files that have been read are remembered; in a folder that
    grows for ever, give an ``archive_dir``, into which they are moved, so that neither the listing
    nor that memory holds on to the folder's past.
    """
    reader = spark.readStream.format("text").option("maxFileAge", max_file_age)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.load(path)


def folder_table(spark: SparkSession, path: str) -> DataFrame:
    """The same folder as a bounded table."""
    return spark.read.text(path)
