"""The registered queries: every operator applied to the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.fixtures import TX_DOMAINS, event_records, event_tx, tx, tx_records
from tillwright.functions.measures import APPROXIMATE, BOUNDED, EXACT
from tillwright.operators import audit, keyed, logs, metrics, quality
from tillwright.plans import daily, dashboard, replay
from tillwright.schema import LITERAL_EVENT_TIME_FORMAT, RECORD_FIELDS, TABLES
from tillwright.session import configure, scratch_folder
from tillwright.sinks.current import CurrentRows
from tillwright.sinks.publish import publish_folder, to_json_records
from tillwright.sinks.tables import FileStore, conform
from tillwright.sources import decode
from tillwright.sources.readers import folder_stream
from tillwright.streaming import job
from tillwright.streaming.batches import BatchTables

Query = Callable[[SparkSession, str], DataFrame]

DAY_SECONDS = 86_400
TRIGGER_SECONDS = 10
LOOKUP_DAY = 19_737  # 2024-01-15 as days since the epoch

# --- sources and projections -------------------------------------------------


def _wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions as a topic delivers them: JSON as bytes."""
    records = to_json_records(tx_records(spark, sf_dir))
    return records.select(F.col("value").cast("binary").alias("value"))


def decode_value(spark, sf_dir):
    return decode.decode_value(_wire(spark, sf_dir))


def parse_json(spark, sf_dir):
    parsed = decode.parse_json(decode.decode_value(_wire(spark, sf_dir)))
    return parsed.select(*[F.col(f"data.{name}").alias(name) for name in RECORD_FIELDS])


def _irregular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record damaged in one of five ways, by its quantity; the fourth is harmless."""
    records = tx_records(spark, sf_dir)
    whole = F.to_json(F.struct(*RECORD_FIELDS), {"ignoreNullFields": "false"})
    mistyped = F.to_json(
        F.struct(
            "transaction_id",
            F.lit("x").alias("price"),
            F.col("quantity").cast("string").alias("quantity"),
            F.col("age").alias("category"),
        )
    )
    half = F.to_json(F.struct("transaction_id", (F.col("quantity") + 0.5).alias("quantity"), "price"))
    # Inline, so that a row builds the one text it needs.
    text = (
        F.when(F.col("quantity") == 1, F.substr(whole, F.lit(1), F.length(whole) - 8))
        .when(F.col("quantity") == 2, mistyped)
        .when(F.col("quantity") == 3, half)
        .when(F.col("quantity") == 4, F.regexp_replace(whole, r"\}$", ',"test":true}'))
        .otherwise(F.lit(""))
    )
    return records.select(text.alias("json"))


def parse_json_irregular(spark, sf_dir):
    """No row is lost, whatever its damage."""
    return decode.flatten_payload(decode.parse_json(_irregular(spark, sf_dir)))


def damaged_records(spark, sf_dir):
    """The same rows beside the text of the damaged ones."""
    return decode.flatten_payload(decode.parse_json(_irregular(spark, sf_dir), damaged=True))


def flatten_payload(spark, sf_dir):
    return decode.flatten_payload(decode.parse_json(decode.decode_value(_wire(spark, sf_dir))))


def to_json_round_trip(spark, sf_dir):
    return decode.decode_transactions(_wire(spark, sf_dir)).drop("processed_at")


def event_time(spark, sf_dir):
    return tx(spark, sf_dir).select("transaction_id", "timestamp", "event_time")


def event_time_literal(spark, sf_dir):
    rows = decode.derive(tx_records(spark, sf_dir), LITERAL_EVENT_TIME_FORMAT)
    return rows.select("transaction_id", "timestamp", "event_time")


def transaction_value(spark, sf_dir):
    return tx(spark, sf_dir).select("transaction_id", "price", "quantity", "transaction_value")


# --- tables ------------------------------------------------------------------


def raw_transactions(spark, sf_dir):
    store = FileStore(scratch_folder(spark, "raw"))
    store.append(tx(spark, sf_dir), "transactions")
    return store.read(spark, "transactions").drop("processed_at")


def latest_by_key(spark, sf_dir):
    columns = ["user_id", "transaction_id", "event_time", "transaction_status", "transaction_value"]
    return keyed.latest_by_key(tx(spark, sf_dir), ["user_id"], ["event_time", "transaction_id"], columns)


def rejected_rows(spark, sf_dir):
    batches = replay.with_batch(tx(spark, sf_dir), DAY_SECONDS)
    rows = metrics.category_metrics(batches, replay.BATCH)
    _, rejected = keyed.split_on_key(rows, TABLES["category_metrics"].key)
    return rejected.select("batch_id", "reason", "order_count", "category_revenue", "avg_order_value")


def clustered_geo(spark, sf_dir):
    batches = replay.with_batch(tx(spark, sf_dir), 365 * DAY_SECONDS)
    rows = metrics.geo_metrics(batches, replay.BATCH, EXACT)
    return keyed.clustered(rows, TABLES["geo_metrics"].key)


def batch_lookup(spark, sf_dir):
    store = FileStore(scratch_folder(spark, "lookup"))
    rows = replay.replay(event_tx(spark, sf_dir), "category_metrics", DAY_SECONDS, EXACT)
    store.replace_batches(rows, "category_metrics")
    return store.lookup(spark, "category_metrics", LOOKUP_DAY)


# --- static metrics and logs -------------------------------------------------


def success_rate(spark, sf_dir):
    return metrics.transaction_metrics(tx(spark, sf_dir)).select(
        "total_transactions", "successful_transactions", "success_rate_percentage"
    )


def unknown_status(spark, sf_dir):
    rows = logs.unknown_status_rows(tx(spark, sf_dir))
    return rows.select("transaction_id", "transaction_status", "transaction_value")


def batch_summary(spark, sf_dir):
    return logs.batch_summary(metrics.transaction_metrics(tx(spark, sf_dir)))


def zero_success_batches(spark, sf_dir):
    batches = replay.with_batch(event_tx(spark, sf_dir), TRIGGER_SECONDS)
    alarmed = logs.zero_success(metrics.transaction_metrics(batches, replay.BATCH))
    return logs.batch_summary(alarmed, replay.BATCH)


def zero_success_statuses(spark, sf_dir):
    return logs.zero_success_statuses(replay.with_batch(event_tx(spark, sf_dir), TRIGGER_SECONDS))


def domain_violations(spark, sf_dir):
    return quality.domain_violations(tx(spark, sf_dir), TX_DOMAINS)


def _on_tx(operator, **parameters) -> Query:
    return lambda spark, sf_dir: operator(tx(spark, sf_dir), **parameters)


# --- replay and rollups ------------------------------------------------------


def _interval(spark, sf_dir, table, width=DAY_SECONDS):
    return replay.replay(event_tx(spark, sf_dir), table, width, EXACT)


def daily_unique_merged(spark, sf_dir):
    hours = replay.with_batch(event_tx(spark, sf_dir), 3600)
    return daily.merged_unique_customers(daily.user_sketches(hours))


def _within_error(operator, group: list[str], counted: list[str], standard_error: float = 0.05) -> Query:
    """The exact counts, and whether each estimate lies within three standard errors of its count.

    Up to 20 values, within 3: there a few collisions outweigh the standard error.
    """

    def query(spark, sf_dir):
        rows = tx(spark, sf_dir)
        estimates = operator(rows, distinct=APPROXIMATE).select(
            *[F.col(name).alias(f"_{name}") for name in (*group, *counted)]
        )
        exact = operator(rows, distinct=EXACT).select(*group, *counted)
        same = F.lit(True)
        for name in group:
            same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
        if group:
            joined = exact.join(estimates, same)
        else:  # one row each, side by side
            names = [*counted, *[f"_{name}" for name in counted]]
            both = exact.unionByName(estimates, allowMissingColumns=True)
            joined = both.agg(*[F.max(name).alias(name) for name in names])
        return joined.select(*group, *counted, _near(counted, standard_error).alias("within_error"))

    return query


def _near(counted: list[str], standard_error: float):
    near = F.lit(True)
    for name in counted:
        allowed = F.greatest(F.lit(3.0), F.col(name) * (3 * standard_error))
        near = near & (F.abs(F.col(f"_{name}") - F.col(name)) <= allowed)
    return near


def daily_unique_error(spark, sf_dir):
    """The merged sketches of hours against the exact counts of days."""
    merged = daily_unique_merged(spark, sf_dir).withColumnRenamed("unique_customers", "_unique_customers")
    day = F.to_date("event_time").cast("string").alias("date")
    exact = event_tx(spark, sf_dir).groupBy(day).agg(F.count_distinct("user_id").alias("unique_customers"))
    # Standard error of a sketch with 2^12 registers.
    near = _near(["unique_customers"], 1.04 / 64).alias("within_error")
    return exact.join(merged, "date").select("date", "unique_customers", near)


# Fields that rejected rows of the six keyed tables show.
_REJECTED_FIELDS = (
    "order_count bigint, category_revenue double, avg_order_value double, unique_products bigint, unique_customers bigint, "
    "transaction_count bigint, successful_revenue double, failed_count bigint, success_rate double, revenue double, "
    "avg_transaction_value double, transaction_id string, user_id string, product_name string, transaction_value double, "
    "payment_method string, country string, city string, category string"
)


def _holey(rows: DataFrame) -> DataFrame:
    """Some products' transactions without a payment method, city or id."""
    product = F.col("product_id").cast("bigint")
    gaps = {"payment_method": 103, "city": 107, "transaction_id": 109}
    return rows.withColumns({name: F.when(product % n != 0, F.col(name)) for name, n in gaps.items()})


def _keyed_tables(rows: DataFrame) -> dict[str, DataFrame]:
    """The keyed tables but the raw one, by year."""
    batches = replay.with_batch(rows, 365 * DAY_SECONDS)
    stamps = {name: F.lit(None).cast("timestamp") for name in ("batch_time", "logged_at", "alert_time")}
    tables = {
        "category_metrics": metrics.category_metrics(batches, replay.BATCH, EXACT),
        "payment_metrics": metrics.payment_metrics(batches, replay.BATCH),
        "geo_metrics": metrics.geo_metrics(batches, replay.BATCH, EXACT),
        "failed_transactions": logs.failed_log(batches, replay.BATCH),
        "high_value_alerts": logs.high_value_alerts(batches, replay.BATCH),
    }
    return {name: made.withColumns(stamps).select(*TABLES[name].columns) for name, made in tables.items()}


def _shown_rejects(rejected: DataFrame) -> DataFrame:
    payload = F.from_json("payload", _REJECTED_FIELDS).alias("p")
    return rejected.select("batch_id", "table_name", "reason", "copy", payload).select(
        "batch_id", "table_name", "reason", "copy", "p.*"
    )


def rejected_tables(spark, sf_dir):
    """Null keys of the six keyed tables, as the store keeps them with their payload."""
    store = FileStore(scratch_folder(spark, "rejects"))
    store.append(_holey(tx(spark, sf_dir)).withColumn("processed_at", F.lit(None).cast("timestamp")), "transactions")
    # The joins are made once: the other tables are made of the rows as they were stored, rejects included.
    for table, made in _keyed_tables(store.appended(spark, "transactions")).items():
        store.replace_batches(made, table)
    return _shown_rejects(store.read(spark, "rejected_rows"))


def rejects_replayed(spark, sf_dir):
    """Rejects of batches that are done again: the second time without the gaps of early years, the third time whole."""
    store = FileStore(scratch_folder(spark, "replayed"))
    rows = tx(spark, sf_dir)
    early = _holey(rows.withColumn("category", F.lit(None).cast("string")))
    for made in (early, rows, _holey(rows)):
        store.replace_batches(_keyed_tables(made)["category_metrics"], "category_metrics")
    shown = _shown_rejects(store.read(spark, "rejected_rows"))
    kept = store.read(spark, "category_metrics").groupBy("batch_id").agg(F.count(F.lit(1)).alias("kept_rows"))
    names = ("order_count", "category_revenue", "avg_order_value", "unique_products", "unique_customers")
    return shown.select("batch_id", "table_name", "reason", "copy", *names).join(kept, "batch_id")


def current_rows(spark, sf_dir):
    """The last purchase of each user, merged year by year; one year comes late, one is done again in other rows."""
    store = FileStore(scratch_folder(spark, "current"))
    rows = tx(spark, sf_dir).withColumns({"transaction_id": F.col("user_id"), "processed_at": F.lit(None).cast("timestamp")})
    # Joined once and kept by year, so that a year is read without the others.
    kept, rows = scratch_folder(spark, "years"), rows.withColumn("_year", F.year("event_time"))
    rows.write.partitionBy("_year").parquet(kept)
    rows = spark.read.schema(rows.schema).parquet(kept)
    held = CurrentRows(store, "transactions", "years", buckets=16)

    def put(year: int, made: DataFrame) -> None:
        store.replace_batch(conform(made, "transactions"), "transactions", "years", year)
        held.merge(spark, year)

    years = [row["_year"] for row in rows.select("_year").distinct().orderBy("_year").collect()]
    late = years[len(years) // 2]
    put(years[-1], rows.filter(F.col("_year") == years[0]))
    for year in [*[year for year in years if year != late], late]:
        put(year, rows.filter(F.col("_year") == year))
    return held.read(spark).select("batch_id", *RECORD_FIELDS)


def compacted_batches(spark, sf_dir):
    """Payment metrics per hour: compacted by day, some batches done again, and compacted once more."""
    store, table, day = FileStore(scratch_folder(spark, "compacted")), "payment_metrics", 24
    rows = replay.replay(event_tx(spark, sf_dir), table, 3600)
    wrong = rows.withColumn("transaction_count", F.lit(-1).cast("bigint"))
    again = F.col("batch_id") % 7 == 0
    store.replace_batches(rows.filter(~again).unionByName(wrong.filter(again)), table)
    store.compact(spark, table, before=LOOKUP_DAY * day, width=day)
    store.replace_batches(rows.filter(again), table)
    store.compact(spark, table, before=(LOOKUP_DAY + 5) * day, width=day)
    return store.read(spark, table)


def daily_stored(spark, sf_dir):
    """The daily rollup, stored twice by key and read back without its clock."""
    store = FileStore(scratch_folder(spark, "rollup"))
    # A row per day, made once for both times.
    rows = daily.daily_aggregates(tx(spark, sf_dir), EXACT).persist()
    try:
        for part in (rows.filter("date < '1995'"), rows):
            store.replace_rollup(part, "daily_aggregates", datetime.now(timezone.utc))
    finally:
        rows.unpersist()
    return store.read_rollup(spark, "daily_aggregates").drop("created_at")


def _arrivals(rows: DataFrame) -> DataFrame:
    """Events in batches that each hold rows of every day, most of them late."""
    return rows.withColumn("batch_id", F.col("transaction_id").cast("bigint") % 5)


def daily_incremental(spark, sf_dir):
    """Days out of the states of late batches, one of which was first written half, then again."""
    store = FileStore(scratch_folder(spark, "state"))
    rows = _arrivals(event_tx(spark, sf_dir))
    half = (F.col("batch_id") != 3) | (F.col("quantity") < 3)
    store.replace_batches(daily.daily_state(rows.filter(half), replay.BATCH), "daily_state")
    store.replace_batches(daily.daily_state(rows.filter("batch_id = 3"), replay.BATCH), "daily_state")
    return daily.from_state(store.read(spark, "daily_state"))


def offset_gaps(spark, sf_dir):
    """Lost and doubled offsets of a ledger of hours, some of which are missing or read twice."""
    place = replay.with_batch(event_tx(spark, sf_dir), 3600).select(
        "batch_id",
        F.lit("events").alias("_source"),
        (F.col("transaction_id").cast("bigint") % 4).cast("int").alias("_partition"),
        F.call_function("div", F.col("transaction_id").cast("bigint"), F.lit(4)).alias("_offset"),
    )
    ledger = audit.read_ledger(place, replay.BATCH)
    missing, twice = F.col("batch_id") % 11 == 3, F.col("batch_id") % 13 == 5
    again = ledger.filter(twice).withColumn("batch_id", F.col("batch_id") + 1_000_000)
    return audit.offset_faults(ledger.filter(~missing).unionByName(again))


def dashboard_stored(spark, sf_dir):
    store = FileStore(scratch_folder(spark, "rollup"))
    rows = dashboard.dashboard_metrics(metrics.transaction_metrics(tx(spark, sf_dir)))
    store.replace_rollup(rows, "dashboard_metrics", datetime.now(timezone.utc))
    return store.read_rollup(spark, "dashboard_metrics").drop("last_updated")


def dashboard_metrics(spark, sf_dir):
    return dashboard.dashboard_metrics(metrics.transaction_metrics(tx(spark, sf_dir)))


def dashboard_latest(spark, sf_dir):
    return dashboard.dashboard_latest(_interval(spark, sf_dir, "transaction_metrics"))


# --- streams -----------------------------------------------------------------

STREAM_ID = "events"
# What lands in the folder before each run of the stream. The second landing has no rows: the
# events begin on 2024-01-01.
LANDINGS = [
    {"until": "2024-01-11"},
    {"until": "2024-01-01"},
    {"since": "2024-01-11", "until": "2024-01-21"},
    {"since": "2024-01-21"},
]


class StreamRun:
    """The event stream, run once per session and folder; the stream queries read its tables.

    Each landing is written and then taken up by a run of the query, so each is one micro-batch,
    and each run but the first is a restart from the checkpoint.
    """

    runs: dict[tuple[str, str], StreamRun] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        folder = scratch_folder(spark, "stream")
        self.landing, self.checkpoint = f"{folder}/landing", f"{folder}/checkpoint"
        self.store = FileStore(f"{folder}/tables")
        for days in LANDINGS:
            publish_folder(to_json_records(event_records(spark, sf_dir, **days)), self.landing)
            self.take_up(spark)

    def take_up(self, spark: SparkSession) -> None:
        on_batch = BatchTables(self.store, STREAM_ID, EXACT)
        raw = folder_stream(spark, self.landing)
        job.wait(job.start(raw, on_batch, self.checkpoint, available_now=True))

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> StreamRun:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls.runs:
            cls.runs[key] = cls(spark, sf_dir)
        return cls.runs[key]


def _stream_table(spark, sf_dir, table):
    rows = StreamRun.of(spark, sf_dir).store.read(spark, table, STREAM_ID)
    return rows.drop("batch_time", "logged_at", "alert_time")


def stream_ingest(spark, sf_dir):
    rows = _stream_table(spark, sf_dir, "transactions")
    return rows.withColumn("processed_at", F.col("processed_at").isNotNull()).withColumnRenamed(
        "processed_at", "is_stamped"
    )


def stream_restart(spark, sf_dir):
    run = StreamRun.of(spark, sf_dir)
    run.take_up(spark)
    rows = run.store.read(spark, "transactions", STREAM_ID)
    return rows.agg(F.count_distinct("batch_id").alias("batches"), F.count(F.lit(1)).alias("transactions"))


def stream_empty_batch(spark, sf_dir):
    return _stream_table(spark, sf_dir, "transaction_metrics").select("batch_id", "total_transactions")


def stream_late_file(spark, sf_dir):
    """All events, the second half in files dated a month before those already taken up."""
    folder = scratch_folder(spark, "late")
    store = FileStore(f"{folder}/tables")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for n, days in enumerate(({"until": "2024-01-16"}, {"since": "2024-01-16"})):
        part = f"{folder}/part-{n}"
        publish_folder(to_json_records(event_records(spark, sf_dir, **days)), part)
        files.mkdirs(path(f"{folder}/landing"))
        for status in files.listStatus(path(part)):
            name = status.getPath().getName()
            if name.startswith("part-"):
                files.setTimes(status.getPath(), status.getModificationTime() - n * 30 * DAY_SECONDS * 1000, -1)
                files.rename(status.getPath(), path(f"{folder}/landing/{n}-{name}"))
        on_batch = BatchTables(store, "late", EXACT)
        raw = folder_stream(spark, f"{folder}/landing")
        job.wait(job.start(raw, on_batch, f"{folder}/checkpoint", available_now=True))
    return store.read(spark, "transactions", "late").agg(F.count(F.lit(1)).alias("transactions"))


def stream_repeats(spark, sf_dir):
    """Every record sent twice, in event order reversed: each is stored once, however late its event time."""
    folder = scratch_folder(spark, "repeats")
    store = FileStore(f"{folder}/tables")
    for days in ({"since": "2024-01-16"}, {"until": "2024-01-16"}):
        records = to_json_records(event_records(spark, sf_dir, **days))
        # Made once, sent twice.
        twice = records.select(F.explode(F.array("value", "value")).alias("value"))
        publish_folder(twice, f"{folder}/landing")
        on_batch = BatchTables(store, "repeats", EXACT)
        raw = folder_stream(spark, f"{folder}/landing")
        query = job.start(
            raw, on_batch, f"{folder}/checkpoint", available_now=True, drop_repeats_within="1 hour"
        )
        job.wait(query)
    rows = store.read(spark, "transactions", "repeats")
    return rows.select("transaction_id", "event_time", "transaction_value")


QUERIES: dict[str, Query] = {
    "decode_value": decode_value,
    "parse_json": parse_json,
    "parse_json_irregular": parse_json_irregular,
    "damaged_records": damaged_records,
    "flatten_payload": flatten_payload,
    "to_json_records": to_json_round_trip,
    "event_time": event_time,
    "event_time_literal_pattern": event_time_literal,
    "transaction_value": transaction_value,
    "raw_transactions": raw_transactions,
    "latest_by_key": latest_by_key,
    "rejected_rows": rejected_rows,
    "clustered_geo": clustered_geo,
    "batch_lookup": batch_lookup,
    "transaction_metrics": _on_tx(metrics.transaction_metrics),
    "success_rate": success_rate,
    "user_metrics": _on_tx(metrics.user_metrics, distinct=EXACT),
    "user_metrics_approx": _on_tx(metrics.user_metrics),
    "category_metrics": _on_tx(metrics.category_metrics, distinct=EXACT),
    "category_metrics_approx": _on_tx(metrics.category_metrics),
    "payment_metrics": _on_tx(metrics.payment_metrics),
    "geo_metrics": _on_tx(metrics.geo_metrics, distinct=EXACT),
    "geo_metrics_approx": _on_tx(metrics.geo_metrics, distinct=APPROXIMATE),
    "failed_transactions": _on_tx(logs.failed_log),
    "high_value_alerts": _on_tx(logs.high_value_alerts),
    "unknown_status": unknown_status,
    "log_counts": _on_tx(metrics.log_counts),
    "status_breakdown": _on_tx(metrics.status_breakdown),
    "sample_records": _on_tx(logs.sample_records),
    "distinct_statuses": _on_tx(logs.distinct_statuses),
    "batch_summary": batch_summary,
    "zero_success_batches": zero_success_batches,
    "zero_success_statuses": zero_success_statuses,
    "status_tally": _on_tx(quality.status_tally),
    "domain_violations": domain_violations,
    "missing_fields": _on_tx(quality.missing_fields),
    "interval_transaction_metrics": partial(_interval, table="transaction_metrics"),
    "interval_transaction_metrics_10s": partial(
        _interval, table="transaction_metrics", width=TRIGGER_SECONDS
    ),
    "interval_user_metrics": partial(_interval, table="user_metrics"),
    "interval_category_metrics": partial(_interval, table="category_metrics"),
    "interval_payment_metrics": partial(_interval, table="payment_metrics"),
    "interval_geo_metrics": partial(_interval, table="geo_metrics"),
    "interval_failed": partial(_interval, table="failed_transactions"),
    "interval_alerts": partial(_interval, table="high_value_alerts"),
    "daily_aggregates": _on_tx(daily.daily_aggregates, distinct=EXACT),
    "daily_aggregates_approx": _on_tx(daily.daily_aggregates, distinct=APPROXIMATE),
    "daily_unique_merged": daily_unique_merged,
    "daily_top_category": _on_tx(daily.top_category),
    "daily_top_country": _on_tx(daily.top_country),
    "dashboard_metrics": dashboard_metrics,
    "dashboard_latest": dashboard_latest,
    "user_metrics_error": _within_error(metrics.user_metrics, [], ["unique_users"]),
    "category_metrics_error": _within_error(
        metrics.category_metrics, ["category"], ["unique_products", "unique_customers"]
    ),
    "geo_metrics_error": _within_error(metrics.geo_metrics, ["country", "city"], ["unique_customers"]),
    "daily_aggregates_error": _within_error(daily.daily_aggregates, ["date"], ["unique_customers"]),
    "daily_unique_error": daily_unique_error,
    "geo_metrics_bounded": _on_tx(metrics.geo_metrics, distinct=BOUNDED),
    "daily_aggregates_bounded": _on_tx(daily.daily_aggregates, distinct=BOUNDED),
    "rejected_tables": rejected_tables,
    "rejects_replayed": rejects_replayed,
    "compacted_batches": compacted_batches,
    "current_rows": current_rows,
    "daily_incremental": daily_incremental,
    "offset_gaps": offset_gaps,
    "daily_stored": daily_stored,
    "dashboard_stored": dashboard_stored,
    "stream_late_file": stream_late_file,
    "stream_repeats": stream_repeats,
    "stream_ingest": stream_ingest,
    "stream_transaction_metrics": partial(_stream_table, table="transaction_metrics"),
    "stream_user_metrics": partial(_stream_table, table="user_metrics"),
    "stream_category_metrics": partial(_stream_table, table="category_metrics"),
    "stream_payment_metrics": partial(_stream_table, table="payment_metrics"),
    "stream_geo_metrics": partial(_stream_table, table="geo_metrics"),
    "stream_failed": partial(_stream_table, table="failed_transactions"),
    "stream_alerts": partial(_stream_table, table="high_value_alerts"),
    "stream_restart": stream_restart,
    "stream_empty_batch": stream_empty_batch,
}


def _configured(query: Query) -> Query:
    return lambda spark, sf_dir: query(configure(spark), sf_dir)


def queries() -> dict[str, Query]:
    return {name: _configured(query) for name, query in QUERIES.items()}
