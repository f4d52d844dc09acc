"""The streaming job for spark-submit: a topic or a folder in, result tables out.

spark-submit --packages <Spark's Kafka package> run_job.py \\
    --servers broker:9092 --topic transactions --tables /shared/tables --checkpoint /shared/checkpoint
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from tillwright.functions.measures import DISTINCT_MODES
from tillwright.schema import EVENT_TIME_FORMAT, HIGH_VALUE_THRESHOLD, TRIGGER_INTERVAL
from tillwright.session import configure
from tillwright.sinks.tables import ConnectorStore, FileStore
from tillwright.sources.readers import folder_stream, topic_stream
from tillwright.streaming import job
from tillwright.streaming.batches import BatchTables


def _pair(text: str) -> tuple[str, str]:
    name, _, value = text.partition("=")
    return name, value


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tillwright", description="Transaction metrics from a topic.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="servers of the topic")
    source.add_argument("--folder", help="folder of JSON-lines files, instead of a topic")
    parser.add_argument("--topic", default="transactions")
    parser.add_argument(
        "--source-option", type=_pair, action="append", default=[], help="name=value of the topic's source"
    )
    parser.add_argument("--max-files-per-trigger", type=int)
    parser.add_argument("--archive-dir", help="where files of the folder go once they are read")
    parser.add_argument("--event-time-format", default=EVENT_TIME_FORMAT)
    parser.add_argument("--starting-offsets", default="latest")
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--stream-id", default="transactions")
    parser.add_argument("--interval", default=TRIGGER_INTERVAL)
    parser.add_argument(
        "--distinct", type=_pair, action="append", default=[], help=f"table=mode of distinct counts: {', '.join(DISTINCT_MODES)}"
    )
    parser.add_argument("--rollups-every", type=int, help="bring daily and dashboard tables up to date after so many batches")
    parser.add_argument("--ledger", action="store_true", help="store what each batch has read of its source")
    parser.add_argument("--damaged", action="store_true", help="keep the text of damaged records among the rejected rows")
    parser.add_argument("--threshold", type=float, default=HIGH_VALUE_THRESHOLD)
    parser.add_argument("--drop-repeats-within", help="for example '1 hour'; off by default")
    parser.add_argument("--tables", help="root folder of the result tables")
    parser.add_argument("--format", default="parquet", help="file format, or a connector's format")
    parser.add_argument("--table-option", default="table", help="the connector's option for a table's name")
    parser.add_argument("--no-stream-id", action="store_true", help="tables behind the connector have no stream_id")
    parser.add_argument("--option", type=_pair, action="append", default=[], help="name=value of the sink")
    options = parser.parse_args(arguments)

    logging.basicConfig(level=logging.INFO)
    spark = configure(SparkSession.builder.appName("tillwright").getOrCreate())
    sink_options = dict(options.option)
    if options.tables:
        store = FileStore(options.tables, options.format, sink_options)
    else:
        store = ConnectorStore(options.format, sink_options, options.table_option, not options.no_stream_id)
    if options.folder:
        raw = folder_stream(
            spark, options.folder, options.max_files_per_trigger, archive_dir=options.archive_dir
        )
    else:
        raw = topic_stream(
            spark,
            options.servers,
            options.topic,
            options.starting_offsets,
            options.min_partitions,
            options.max_offsets_per_trigger,
            dict(options.source_option),
        )
    on_batch = BatchTables(
        store, options.stream_id, dict(options.distinct), options.threshold, rollups_every=options.rollups_every
    )
    query = job.start(
        raw,
        on_batch,
        options.checkpoint,
        interval=options.interval,
        event_time_format=options.event_time_format,
        drop_repeats_within=options.drop_repeats_within,
        name=options.stream_id,
        damaged=options.damaged,
        ledger=options.ledger,
    )
    job.wait(query)


if __name__ == "__main__":
    main()
