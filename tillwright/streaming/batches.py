"""What happens to one micro-batch: every result table, written so that a retry replaces it."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillwright.functions.measures import APPROXIMATE, BOUNDED, DISTINCT_MODES
from tillwright.operators import audit, logs, metrics
from tillwright.operators.keyed import split_on_key
from tillwright.plans import daily, dashboard
from tillwright.schema import HIGH_VALUE_THRESHOLD, TABLES
from tillwright.sinks.current import CurrentRows
from tillwright.sinks.tables import FileStore, Store, conform, numbered_copies, rejects
from tillwright.sources.decode import DAMAGED, PLACE

log = logging.getLogger(__name__)

# How each table counts distinct values unless told otherwise. There may be as many locations as rows.
DISTINCT_BY_TABLE = {"user_metrics": APPROXIMATE, "category_metrics": APPROXIMATE, "geo_metrics": BOUNDED}


# Rows that a rejected record of a keyed table shows as its reason, where its text was damaged.
DAMAGED_REASON = "damaged record"


class BatchTables:
    """Callback for ``foreachBatch``.

    The batch is decoded once and persisted, since nine tables are computed from it; its size is
    bounded by the source options. The raw rows are written first, which fills the persisted batch, and
    the totals are observed on the way: they tell whether there is more to do, without a job of
    their own. An error is raised, not swallowed: the query fails, its checkpoint does not move, and the
    restarted query does the same batch again.

    ``distinct`` is one mode for all tables or a mode per table. With ``rollups_every``, the days' states are
    stored too, and after each so many batches the daily rows of the days touched in them and the
    dashboard's values are brought up to date. A batch with the places of its records (``job.start`` with
    ``ledger``) gets its rows of ``read_ledger``. Each batch is merged into the ``CurrentRows`` of the tables in
    ``current``.
    """

    def __init__(
        self,
        store: Store,
        stream_id: str,
        distinct: str | Mapping[str, str] | None = None,
        threshold: float = HIGH_VALUE_THRESHOLD,
        on_summary: Callable[[int, dict], None] | None = None,
        parallel_writes: int = 8,
        on_counts: Callable[[int, dict], None] | None = None,
        rollups_every: int | None = None,
        current: Sequence[str] = (),
    ):
        self.store, self.stream_id = store, stream_id
        modes = {table: distinct for table in DISTINCT_BY_TABLE} if isinstance(distinct, str) else dict(distinct or {})
        if unknown := modes.keys() - DISTINCT_BY_TABLE.keys() or set(modes.values()) - set(DISTINCT_MODES):
            raise ValueError(f"no such table or mode of distinct counts: {', '.join(sorted(unknown))}")
        self.distinct, self.threshold = {**DISTINCT_BY_TABLE, **modes}, threshold
        self.on_summary, self.parallel_writes = on_summary, parallel_writes
        self.on_counts = on_counts
        if rollups_every is not None and not (hasattr(store, "replace_rollup") and hasattr(store, "read")):
            raise ValueError("this store keeps no rollups")
        self.rollups_every = rollups_every
        if current and not isinstance(store, FileStore):
            raise ValueError("this store keeps no batches to merge from")
        self.current = [CurrentRows(store, table, stream_id) for table in current]
        self._owner: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._claim(batch)
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            stamps = self._stamps(batch_id)
            row = self._write_raw(batch, batch_id, stamps)
            if row["total_transactions"] == 0:
                log.info("batch %d: no records", batch_id)
            else:
                tables = self._tables(batch)
                tables["transaction_metrics"] = lambda: self._totals_row(batch, row)
                if row["success_rate_percentage"] == 0.0:
                    log.warning("batch %d: no successful transaction", batch_id)
                    tables["zero_success_statuses"] = lambda: logs.alarmed_statuses(batch)
                self._write(batch, batch_id, tables, stamps)
                self._report(batch, batch_id, row)
            for rows in self.current:
                rows.merge(batch.sparkSession, batch_id)
            if self.rollups_every and (batch_id + 1) % self.rollups_every == 0:
                self._roll_up(batch.sparkSession, batch_id, stamps["batch_time"])
        finally:
            batch.unpersist()

    def _stamps(self, batch_id: int) -> dict:
        """One clock value for all tables of the batch."""
        now = datetime.now(timezone.utc)
        return {"batch_id": batch_id, **{name: now for name in ("batch_time", "logged_at", "alert_time")}}

    def _observed(self) -> dict[str, Column]:
        counts = dict(zip(metrics.LOG_COUNTS, metrics.log_count_columns(self.threshold), strict=True))
        return {**metrics.total_columns(), **counts}

    def _write_raw(self, batch: DataFrame, batch_id: int, stamps: dict) -> dict:
        """Write the raw rows; the totals and the counts of failures and alerts come from the same job.

        It has one stage, each of whose tasks counts once, however often it is tried.
        """
        seen = Observation()
        observed = batch.observe(seen, *[column.alias(name) for name, column in self._observed().items()])
        kept, _ = split_on_key(observed, TABLES["transactions"].key)
        self._store(kept, "transactions", batch_id, stamps)
        row = dict(seen.get)
        rate = 0.0
        if row["total_transactions"]:
            # Half up in integers, as in the tables.
            rate = (row["successful_transactions"] * 20_000 + row["total_transactions"]) // (2 * row["total_transactions"]) / 100
        return {**row, "success_rate_percentage": rate}

    def _totals_row(self, batch: DataFrame, row: dict) -> DataFrame:
        names = [name for name in TABLES["transaction_metrics"].columns if name in row]
        schema = ", ".join(f"{name} {TABLES['transaction_metrics'].columns[name]}" for name in names)
        return batch.sparkSession.createDataFrame([tuple(row[name] for name in names)], schema).coalesce(1)

    def _store(self, rows: DataFrame, table: str, batch_id: int, stamps: dict) -> None:
        stamped = rows.withColumns({name: F.lit(value) for name, value in stamps.items()})
        self.store.replace_batch(conform(stamped, table), table, self.stream_id, batch_id)

    def _roll_up(self, spark: SparkSession, batch_id: int, now: datetime) -> None:
        """The days touched by the last batches, from the states of all, and the newest totals."""
        state = self.store.read(spark, "daily_state", self.stream_id)
        recent = F.col("batch_id").between(batch_id - self.rollups_every + 1, batch_id)
        touched = daily.days_of(state, state.filter(recent))
        self.store.replace_rollup(daily.from_state(touched), "daily_aggregates", now)
        totals = self.store.read(spark, "transaction_metrics", self.stream_id).filter(recent)
        self.store.replace_rollup(dashboard.dashboard_latest(totals).drop("last_updated"), "dashboard_metrics", now)

    def _claim(self, batch: DataFrame) -> None:
        """Once per run of the query, in a store that keeps owners; outside a stream there is none."""
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        claim = getattr(self.store, "claim", None)
        if claim and query_id and query_id != self._owner:
            claim(batch.sparkSession, self.stream_id, query_id)
            self._owner = query_id

    def _tables(self, batch: DataFrame) -> dict[str, Callable[[], DataFrame]]:
        """How to build each table from the batch, but for its raw and its metrics rows."""
        tx = batch.drop(*PLACE, DAMAGED)
        keyed = {
            "transactions": lambda: batch.drop(*PLACE),
            "category_metrics": lambda: metrics.category_metrics(tx, distinct=self.distinct["category_metrics"]),
            "payment_metrics": lambda: metrics.payment_metrics(tx),
            "geo_metrics": lambda: metrics.geo_metrics(tx, distinct=self.distinct["geo_metrics"]),
            "failed_transactions": lambda: logs.failed_log(tx),
            "high_value_alerts": lambda: logs.high_value_alerts(tx, threshold=self.threshold),
        }

        def split(table: str) -> tuple[DataFrame, DataFrame, list[str]]:
            key = [name for name in TABLES[table].key if name != "batch_id"]
            kept, unkeyed = split_on_key(keyed[table](), key)
            return kept, unkeyed, key

        def kept(table: str) -> DataFrame:
            rows, _, key = split(table)
            return rows.sortWithinPartitions(*key)

        def rejected() -> DataFrame:
            # A null test on a grouping column moves below the aggregate, so the rejects cost a
            # filtered scan of the persisted batch, not a second aggregation of it.
            parts = {table: split(table)[1] for table in keyed}
            shaped = [
                rejects(rows, table, [name for name in rows.columns if name not in ("reason", DAMAGED)])
                for table, rows in parts.items()
            ]
            if DAMAGED in batch.columns:
                # With or without a key, the text of a damaged record is kept as it came.
                texts = batch.filter(F.col(DAMAGED).isNotNull())
                shown = F.lit("transactions").alias("table_name"), F.lit(DAMAGED_REASON).alias("reason"), F.col(DAMAGED).alias("payload")
                shaped.append(numbered_copies(texts.select(*shown)))
            return reduce(DataFrame.unionByName, shaped)

        others = {
            "user_metrics": lambda: metrics.user_metrics(tx, distinct=self.distinct["user_metrics"]),
            "rejected_rows": rejected,
        }
        if self.rollups_every:
            others["daily_state"] = lambda: daily.daily_state(tx)
        if PLACE[0] in batch.columns:
            others["read_ledger"] = lambda: audit.read_ledger(batch)
        return {**{table: partial(kept, table) for table in keyed if table != "transactions"}, **others}

    def _write(self, batch: DataFrame, batch_id: int, tables: dict[str, Callable[[], DataFrame]], stamps: dict) -> None:
        """Write the tables side by side, so that none waits for another's last task."""

        def write(table: str, build: Callable[[], DataFrame]) -> None:
            self._store(build(), table, batch_id, stamps)

        task = inheritable_thread_target(batch.sparkSession)(write)
        with ThreadPoolExecutor(self.parallel_writes) as pool:
            writes = [pool.submit(task, table, build) for table, build in tables.items()]
        for done in writes:
            done.result()

    def _report(self, batch: DataFrame, batch_id: int, row: dict) -> None:
        summary = {name: row[name] for name in logs.SUMMARY_COLUMNS}
        counts = {name: row[name] for name in metrics.LOG_COUNTS}
        log.info("batch %d: %s", batch_id, summary)
        log.info("batch %d rows logged: %s", batch_id, counts)
        if log.isEnabledFor(logging.DEBUG):
            # Statuses are free text and may be many: the most frequent, and how many there are.
            breakdown = metrics.status_breakdown(batch)
            frequent = breakdown.orderBy(F.desc("count"), "transaction_status").take(20)
            log.debug("batch %d: %d statuses, most frequent %s", batch_id, breakdown.count(), frequent)
            log.debug("batch %d sample: %s", batch_id, logs.sample_records(batch).collect())
        if self.on_summary is not None:
            self.on_summary(batch_id, summary)
        if self.on_counts is not None:
            self.on_counts(batch_id, counts)
