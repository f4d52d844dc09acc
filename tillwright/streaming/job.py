"""Life of the streaming query: start, wait, stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwright.schema import EVENT_TIME_FORMAT, TRIGGER_INTERVAL
from tillwright.session import configure
from tillwright.sources.decode import decode_transactions, with_place


def drop_repeats(tx: DataFrame, within: str) -> DataFrame:
    """Drop repeated transaction ids that arrive within a span of time, as senders' retries do.

    Off unless asked for: the metrics otherwise count a repeated record each time. The span is one of
    arrival (``processed_at``), not of event time: a record with an old, future or missing event time
    is no repeat and stays. State is bounded by the span. Records without an id pass untouched, each
    under an id of its own here, as nothing tells whether they repeat.
    """
    marked = tx.withColumn("_id", F.coalesce("transaction_id", F.uuid()))
    return marked.withWatermark("processed_at", within).dropDuplicatesWithinWatermark(["_id"]).drop("_id")


def start(
    raw: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str = TRIGGER_INTERVAL,
    available_now: bool = False,
    event_time_format: str = EVENT_TIME_FORMAT,
    drop_repeats_within: str | None = None,
    name: str | None = None,
    damaged: bool = False,
    ledger: bool = False,
) -> StreamingQuery:
    """Decode a raw stream and run ``on_batch`` on every micro-batch.

    ``checkpoint`` holds offsets and batch ids and must outlive the job; it has no default, since a
    lost checkpoint restarts batch ids at 0. ``available_now`` handles what is there and ends. The state
    store is the session's choice; with ``drop_repeats_within`` over a long span, choose one on disk.
    ``damaged`` keeps the text of damaged records among the rejects, ``ledger`` what each batch has read.
    """
    configure(raw.sparkSession)
    if ledger and drop_repeats_within:
        raise ValueError("a ledger of what was read needs all records, repeats too")
    tx = decode_transactions(with_place(raw) if ledger else raw, event_time_format, damaged)
    if drop_repeats_within:
        tx = drop_repeats(tx, drop_repeats_within)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    writer = (
        tx.writeStream.foreachBatch(on_batch)
        .outputMode("append")
        .trigger(**trigger)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.queryName(name) if name else writer).start()


def wait(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for the query to end, raising its error if it failed; on an interrupt stop it.

    True if it has ended, False if ``timeout`` seconds passed first.
    """
    try:
        if timeout is None:
            query.awaitTermination()
            return True
        return bool(query.awaitTermination(timeout))
    except KeyboardInterrupt:
        query.stop()
        return True
