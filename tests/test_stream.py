"""The streaming job on a folder source: sums, restarts, failures, retries."""

import json
import logging
from unittest import mock

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tillwright.fixtures import event_records, event_tx
from tillwright.operators import logs, metrics
from tillwright.plans.catalog import LANDINGS, StreamRun
from tillwright.schema import TABLES
from tillwright.session import scratch_folder
from tillwright.sinks.publish import publish_folder, to_json_records
from tillwright.sinks.tables import FileStore
from tillwright.sources.readers import folder_stream, folder_table, topic_stream
from tillwright.streaming import job
from tillwright.streaming.batches import BatchTables

SF = "/root/testdata/sf0.001"
TIME = "2024-03-05 10:00:00"


class Shop:
    """A landing folder, a checkpoint and a store."""

    def __init__(self, spark):
        self.spark = spark
        folder = scratch_folder(spark, "shop")
        self.landing, self.checkpoint = f"{folder}/landing", f"{folder}/checkpoint"
        self.store = FileStore(f"{folder}/tables")

    def land(self, *records):
        lines = [(json.dumps(r),) if isinstance(r, dict) else (r,) for r in records]
        publish_folder(self.spark.createDataFrame(lines, "value string").coalesce(1), self.landing)

    def run(self, store=None, files=None, **options):
        callback = {name: options.pop(name) for name in ("distinct", "threshold", "on_summary") if name in options}
        on_batch = BatchTables(store or self.store, "shop", **callback)
        raw = folder_stream(self.spark, self.landing, files)
        query = job.start(raw, on_batch, self.checkpoint, available_now=True, **options)
        assert job.wait(query)

    def table(self, name):
        return self.store.read(self.spark, name, "shop")


@pytest.fixture
def shop(spark):
    return Shop(spark)


def sale(key, status="Success", price=600.0, **more):
    return {
        "transaction_id": key,
        "user_id": "u",
        "category": "Books",
        "payment_method": "UPI",
        "country": "X",
        "city": "Y",
        "quantity": 1,
        "price": price,
        "transaction_status": status,
        "timestamp": TIME,
        **more,
    }


def ids(frame):
    return sorted((r["batch_id"], r["transaction_id"]) for r in frame.select("batch_id", "transaction_id").collect())


def test_batches_add_up_to_the_table(spark):
    """Many batches, whatever files they take: additive measures equal the static ones."""
    shop = Shop(spark)
    publish_folder(to_json_records(event_records(spark, SF)).repartition(6), shop.landing)
    shop.run(files=2)
    tx = event_tx(spark, SF)
    stats = shop.table("transaction_metrics")
    assert stats.count() == 3
    got = stats.agg(
        F.sum("total_transactions"),
        F.sum("successful_transactions"),
        F.sum("failed_transactions"),
        F.sum("pending_transactions"),
        F.round(F.sum("total_revenue"), 2),
        F.max("max_transaction_value"),
        F.min("min_transaction_value"),
    ).first()
    want = metrics.transaction_metrics(tx).first()
    assert tuple(got) == (
        want["total_transactions"],
        want["successful_transactions"],
        want["failed_transactions"],
        want["pending_transactions"],
        want["total_revenue"],
        want["max_transaction_value"],
        want["min_transaction_value"],
    )
    geo = shop.table("geo_metrics").groupBy("country", "city").agg(F.sum("transaction_count").alias("n"))
    want = metrics.geo_metrics(tx).select("country", "city", F.col("transaction_count").alias("n"))
    assert geo.exceptAll(want).isEmpty() and want.exceptAll(geo).isEmpty()
    for table, rows in {"failed_transactions": logs.failed_log(tx), "high_value_alerts": logs.high_value_alerts(tx)}.items():
        have = shop.table(table).select(*rows.columns)
        assert have.exceptAll(rows).isEmpty() and rows.exceptAll(have).isEmpty()
    assert shop.table("rejected_rows").isEmpty()


def test_tables_have_their_columns_and_one_clock(spark, shop):
    shop.land(sale("a", "Failed"), sale("b", price=2000.0))
    shop.run()
    stamps = set()
    for name in TABLES.keys() - {"daily_aggregates", "dashboard_metrics", "zero_success_statuses"}:
        frame = shop.table(name)
        assert {**dict(frame.dtypes), "batch_id": "bigint"} == {**TABLES[name].columns, "batch_id": "bigint"}
        for stamp in {"batch_time", "logged_at", "alert_time"} & set(frame.columns):
            stamps |= {r[0] for r in frame.select(stamp).collect()}
    assert len(stamps) == 1


def test_restart_adds_nothing_and_goes_on(shop):
    shop.land(sale("a"))
    shop.run()
    shop.run()
    shop.land(sale("b"))
    shop.run()
    assert ids(shop.table("transactions")) == [(0, "a"), (1, "b")]
    assert shop.table("transaction_metrics").count() == 2


def test_empty_batch_writes_nothing(shop):
    shop.land()
    shop.run()
    shop.land(sale("a"))
    shop.run()
    assert [r["batch_id"] for r in shop.table("transaction_metrics").collect()] == [1]


class Failing:
    """A store that fails on one table until told otherwise."""

    def __init__(self, store, table):
        self.store, self.table, self.broken = store, table, True

    def replace_batch(self, rows, table, stream_id, batch_id):
        if self.broken and table == self.table:
            raise OSError("store is down")
        self.store.replace_batch(rows, table, stream_id, batch_id)


@pytest.mark.parametrize("table", ["transactions", "geo_metrics", "high_value_alerts"])
def test_failed_batch_fails_the_query_and_is_done_again(shop, table):
    shop.land(sale("a", price=2000.0), sale("b", "Failed"))
    store = Failing(shop.store, table)
    with pytest.raises(StreamingQueryException, match="store is down"):
        shop.run(store=store)
    store.broken = False
    shop.run(store=store)
    assert ids(shop.table("transactions")) == [(0, "a"), (0, "b")]
    assert ids(shop.table("high_value_alerts")) == [(0, "a")]
    assert ids(shop.table("failed_transactions")) == [(0, "b")]
    assert [r["total_transactions"] for r in shop.table("transaction_metrics").collect()] == [2]
    assert shop.table("geo_metrics").count() == 1


def test_bad_records_are_counted_and_rejected_not_lost(shop):
    shop.land(
        sale("a"),
        "{broken",
        {"transaction_id": "test-connection", "transaction_status": "Success", "test": True, "timestamp": TIME},
        sale("z", timestamp="2024-1-1 0:0:0"),
    )
    shop.run()
    row = shop.table("transaction_metrics").first()
    assert (row["total_transactions"], row["unknown_status"]) == (4, 1)
    assert ids(shop.table("transactions")) == [(0, "a"), (0, "test-connection"), (0, "z")]
    rejected = {(r["table_name"], r["reason"]): json.loads(r["payload"]) for r in shop.table("rejected_rows").collect()}
    assert set(rejected) == {
        ("transactions", "null key: transaction_id"),
        ("category_metrics", "null key: category"),
        ("payment_metrics", "null key: payment_method"),
        ("geo_metrics", "null key: country, city"),
    }
    assert rejected[("category_metrics", "null key: category")]["order_count"] == 2
    assert [r["order_count"] for r in shop.table("category_metrics").collect()] == [2]


def test_alarm_and_summary(shop, caplog):
    shop.land(sale("a", "Failed"), sale("b", "success"), sale("c", None))
    seen = {}
    with caplog.at_level(logging.DEBUG, logger="tillwright"):
        shop.run(on_summary=seen.__setitem__, threshold=100, distinct="exact")
    assert list(seen) == [0] and list(seen[0]) == logs.SUMMARY_COLUMNS
    assert seen[0]["total_transactions"] == 3 and seen[0]["success_rate_percentage"] == 0.0
    statuses = {r["transaction_status"] for r in shop.table("zero_success_statuses").collect()}
    assert statuses == {"Failed", "success", None}
    assert any("no successful" in record.getMessage() for record in caplog.records)
    assert shop.table("high_value_alerts").count() == 3


def test_repeats_count_unless_dropped(spark):
    for within, want in ((None, 5), ("1 hour", 4)):
        shop = Shop(spark)
        shop.land(sale("a"), sale("a"), sale(None), sale(None), sale("c", timestamp="bad"))
        shop.run(drop_repeats_within=within)
        assert shop.table("transaction_metrics").agg(F.sum("total_transactions")).first()[0] == want
        assert shop.table("rejected_rows").filter("table_name = 'transactions'").count() == 2


def test_trigger_wait_and_stop(spark, shop):
    shop.land(sale("a"))
    query = job.start(
        folder_stream(spark, shop.landing),
        BatchTables(shop.store, "shop"),
        shop.checkpoint,
        interval="1 second",
        name="live",
    )
    try:
        assert query.name == "live" and not job.wait(query, timeout=0.5)
        query.processAllAvailable()
        shop.land(sale("b"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert job.wait(query)
    assert ids(shop.table("transactions")) == [(0, "a"), (1, "b")]


def test_interrupt_stops_the_query(spark, shop):
    shop.land(sale("a"))
    query = job.start(folder_stream(spark, shop.landing), BatchTables(shop.store, "shop"), shop.checkpoint)
    with mock.patch.object(query, "awaitTermination", side_effect=KeyboardInterrupt):
        assert job.wait(query)
    assert not query.isActive


def test_folder_as_a_table(spark, shop):
    shop.land(sale("a"), sale("b"))
    assert folder_table(spark, shop.landing).count() == 2


def test_a_later_record_of_a_transaction_replaces_it(spark, shop):
    shop.land(sale("a", "Pending"), sale("b"))
    shop.run()
    shop.land(sale("a", "Success"), sale("a", "Failed"))
    shop.run()
    assert shop.table("transactions").count() == 4
    got = {(r["transaction_id"], r["batch_id"], r["transaction_status"]) for r in shop.store.latest(
        spark, "transactions", "shop").collect()}
    assert got == {("a", 1, "Success"), ("b", 0, "Success")}


def test_job_script(spark, shop, monkeypatch):
    """The script's wiring, with a folder for the topic."""
    from tillwright import __main__ as script

    shop.land(sale("a", price=70.0), sale("b", price=40.0))
    monkeypatch.setattr(script, "topic_stream", lambda spark, *_: folder_stream(spark, shop.landing))
    start = job.start
    monkeypatch.setattr(job, "start", lambda *args, **more: start(*args, **{**more, "available_now": True}))
    script.main(
        ["--servers", "b:1", "--tables", shop.store.root, "--checkpoint", shop.checkpoint]
        + ["--stream-id", "shop", "--threshold", "50", "--option", "compression=gzip"]
    )
    assert ids(shop.table("high_value_alerts")) == [(0, "a")]
    assert all(file.endswith(".gz.parquet") for file in shop.table("transactions").inputFiles())


def test_published_topic_options(spark, shop):
    from pyspark.sql import DataFrameWriter

    from tillwright.sinks.publish import publish_topic

    given = {}

    def option(writer, name, value):
        given[name] = value
        return writer

    records = spark.createDataFrame([("{}",)], "value string")
    with mock.patch.object(DataFrameWriter, "option", option), mock.patch.object(DataFrameWriter, "save"):
        publish_topic(records, "broker:9092", "sales", {"kafka.linger.ms": "10"})
    assert given == {"kafka.bootstrap.servers": "broker:9092", "topic": "sales"}


def test_topic_options(spark):
    """No Kafka package here: the options are checked, the source is not run."""
    from pyspark.sql.streaming import DataStreamReader

    given = {}

    def option(reader, name, value):
        given[name] = value
        return reader

    with mock.patch.object(DataStreamReader, "option", option), mock.patch.object(DataStreamReader, "load"):
        topic_stream(spark, "broker:9092", "sales", "earliest", 40, 1_000_000)
    assert given == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "sales",
        "startingOffsets": "earliest",
        "minPartitions": 40,
        "maxOffsetsPerTrigger": 1_000_000,
    }


def test_landings_of_the_registered_stream_cover_all_events(spark):
    landed = sum(event_records(spark, SF, **days).count() for days in LANDINGS)
    assert landed == event_records(spark, SF).count()
    run = StreamRun.of(spark, SF)
    assert run is StreamRun.of(spark, SF)
    assert run.store.read(spark, "transactions", "events").count() == landed
