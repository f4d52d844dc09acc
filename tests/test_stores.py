"""Replayed rejects, compaction, rollups by the stream, ledgers, damaged records, and stores behind connectors."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from tests.test_round2 import land, record
from tests.test_tables import counts, payments
from tillwright.operators import audit, metrics
from tillwright.plans import daily
from tillwright.schema import TABLES
from tillwright.session import scratch_folder
from tillwright.sinks import folders
from tillwright.sinks.tables import ConnectorStore, FileStore
from tillwright.sources.readers import folder_stream
from tillwright.streaming import job
from tillwright.streaming.batches import BatchTables

PAYMENTS = "payment_metrics"


@pytest.fixture
def store(spark):
    return FileStore(scratch_folder(spark, "t"))


def refused(store, spark):
    rows = store.read(spark, "rejected_rows").collect()
    return sorted((r["batch_id"], r["table_name"], r["reason"], json.loads(r["payload"])["transaction_count"], r["copy"]) for r in rows)


def test_a_replay_replaces_rejects(spark, store):
    first = payments(spark, [(1, None, 1), (1, None, 1), (1, "UPI", 2), (2, None, 3)])
    for _ in range(2):
        store.replace_batches(first, PAYMENTS)
        reason = "null key: payment_method"
        assert refused(store, spark) == [(1, PAYMENTS, reason, 1, 1), (1, PAYMENTS, reason, 1, 2), (2, PAYMENTS, reason, 3, 1)]
        assert counts(store.read(spark, PAYMENTS)) == [(1, "UPI", 2)]
    keys = {tuple(r[c] for c in TABLES["rejected_rows"].key) for r in store.read(spark, "rejected_rows").collect()}
    assert len(keys) == 3
    # A batch whose replay has no rejects has none left, and the other keeps its own.
    store.replace_batches(payments(spark, [(1, "COD", 9)]), PAYMENTS)
    assert refused(store, spark) == [(2, PAYMENTS, reason, 3, 1)]
    assert counts(store.read(spark, PAYMENTS)) == [(1, "COD", 9)]


def test_rejects_of_appended_rows_and_of_batches_are_read_together(spark, store):
    store.append(payments(spark, [(5, None, 1), (5, "UPI", 2)]), PAYMENTS)
    store.replace_batches(payments(spark, [(6, None, 4), (None, "UPI", 5)]), PAYMENTS)
    assert counts(store.read(spark, PAYMENTS)) == [(5, "UPI", 2)]
    rows = store.read(spark, "rejected_rows").collect()
    assert sorted((str(r["batch_id"]), r["reason"]) for r in rows) == [
        ("5", "null key: payment_method"), ("6", "null key: payment_method"), ("None", "null key: batch_id")
    ]


def test_a_batch_that_was_never_written_is_empty(spark, store):
    for stream in (None, "s"):
        rows = store.lookup(spark, PAYMENTS, 7, stream)
        assert rows.columns == list(TABLES[PAYMENTS].columns) and rows.count() == 0
    store.replace_batch(payments(spark, [(1, "UPI", 1)]), PAYMENTS, "s", 1)
    assert store.lookup(spark, PAYMENTS, 2, "s").count() == 0
    assert "batch_id" in store.lookup(spark, "transactions", 2, "s").columns


# --- compaction --------------------------------------------------------------


def folders_of(spark, store, stream="s"):
    return sorted(n for n in folders.subfolders(spark, store._batches(PAYMENTS, stream)) if n.startswith("batch_id"))


def test_compaction_leaves_results_and_few_files(spark, store):
    def put(n, count):
        store.replace_batch(payments(spark, [(n, "UPI", count), (n, "COD", -n)] if count else []), PAYMENTS, "s", n)

    def wanted():
        return sorted([(n, "UPI", c) for n, c in held.items() if c] + [(n, "COD", -n) for n, c in held.items() if c])

    held = {n: n + 1 for n in range(12)}
    for n, count in held.items():
        put(n, count)
    assert store.compact(spark, PAYMENTS, "s", before=10, width=5) == 10
    assert folders_of(spark, store) == ["batch_id=10", "batch_id=11"]
    assert counts(store.read(spark, PAYMENTS, "s")) == wanted()
    # Batches are replaced in ranges: by other rows, and by none.
    held |= {3: 77, 4: 0}
    put(3, 77), put(4, 0)
    for again in (False, True):
        if again:
            assert store.compact(spark, PAYMENTS, "s", before=5, width=5) == 2
            assert folders_of(spark, store) == ["batch_id=10", "batch_id=11"]
        assert counts(store.read(spark, PAYMENTS, "s")) == wanted()
        for n in range(13):
            own = [r for r in wanted() if r[0] == n]
            assert counts(store.lookup(spark, PAYMENTS, n, "s", width=5)) == own
    assert counts(store.latest(spark, PAYMENTS, "s")) == wanted()
    files = [f for f in store.read(spark, PAYMENTS, "s").inputFiles() if "/compacted/" in f]
    assert len(files) == 2 and len(store.lookup(spark, PAYMENTS, 7, "s", width=5).inputFiles()) <= 2
    assert store.compact(spark, PAYMENTS, "s", before=5, width=5) == 0


def test_a_compaction_that_fails_changes_nothing(spark, store, monkeypatch):
    for n in range(4):
        store.replace_batch(payments(spark, [(n, "UPI", n)]), PAYMENTS, "s", n)
    want = [(n, "UPI", n) for n in range(4)]
    # Written whole, and ended before batches are deleted.
    monkeypatch.setattr(folders, "delete", lambda *_: (_ for _ in ()).throw(RuntimeError("ended")))
    with pytest.raises(RuntimeError):
        store.compact(spark, PAYMENTS, "s", width=10)
    monkeypatch.undo()
    assert counts(store.read(spark, PAYMENTS, "s")) == want
    store.replace_batch(payments(spark, [(2, "UPI", 9)]), PAYMENTS, "s", 2)
    want[2] = (2, "UPI", 9)
    # An incomplete version, of which nobody reads.
    version = f"{store._compacted(PAYMENTS, 's')}/range=0/version=9"
    payments(spark, [(0, "COD", 5)]).write.parquet(version)
    folders.delete(spark, f"{version}/_SUCCESS")
    assert counts(store.read(spark, PAYMENTS, "s")) == want
    folders.delete(spark, version)
    store.compact(spark, PAYMENTS, "s", width=10)
    assert folders_of(spark, store) == [] and counts(store.read(spark, PAYMENTS, "s")) == want


def test_rejects_are_compacted_with_their_batch(spark, store):
    store.replace_batches(payments(spark, [(1, None, 1), (1, "UPI", 2), (2, "UPI", 3), (None, "UPI", 1)]), PAYMENTS)
    before = sorted(r["reason"] for r in store.read(spark, "rejected_rows").collect())
    assert store.compact(spark, PAYMENTS) == 2
    assert sorted(r["reason"] for r in store.read(spark, "rejected_rows").collect()) == before
    assert counts(store.read(spark, PAYMENTS)) == [(1, "UPI", 2), (2, "UPI", 3)]
    store.replace_batches(payments(spark, [(1, "UPI", 8)]), PAYMENTS)
    assert sorted(r["reason"] for r in store.read(spark, "rejected_rows").collect()) == ["null key: batch_id"]


def test_a_batch_replaced_during_compaction_keeps_its_folder(spark, store, monkeypatch):
    for n in range(3):
        store.replace_batch(payments(spark, [(n, "UPI", n)]), PAYMENTS, "s", n)
    seen = store._loose
    calls = []

    def late(spark, table, stream):
        found = seen(spark, table, stream)
        calls.append(found)
        if len(calls) == 2:  # after the range was written
            store.replace_batch(payments(spark, [(1, "UPI", 50)]), PAYMENTS, "s", 1)
            return {n: at + (n == 1) for n, at in seen(spark, table, stream).items()}
        return found

    monkeypatch.setattr(store, "_loose", late)
    store.compact(spark, PAYMENTS, "s")
    monkeypatch.undo()
    assert folders_of(spark, store) == ["batch_id=1"]
    assert counts(store.read(spark, PAYMENTS, "s")) == [(0, "UPI", 0), (1, "UPI", 50), (2, "UPI", 2)]


# --- rollups -----------------------------------------------------------------


def days(spark, rows):
    frame = spark.createDataFrame(rows, "date string, total_transactions bigint")
    for name, dtype in TABLES["daily_aggregates"].columns.items():
        if name not in frame.columns:
            frame = frame.withColumn(name, F.lit(None).cast(dtype))
    return frame


def test_only_parts_with_new_rows_are_written(spark, store):
    first, second = datetime(2024, 5, 1, tzinfo=timezone.utc), datetime(2024, 5, 2, tzinfo=timezone.utc)
    store.replace_rollup(days(spark, [("2024-01-30", 1), ("2024-01-31", 2), ("2024-02-01", 3), (None, 4)]), "daily_aggregates", first)
    january = {f for f in store.read_rollup(spark, "daily_aggregates").inputFiles() if "part=2024-01" in f}
    store.replace_rollup(days(spark, [("2024-02-01", 30), ("2024-02-02", 40)]), "daily_aggregates", second)
    rows = store.read_rollup(spark, "daily_aggregates")
    got = {(r["date"], r["total_transactions"], r["created_at"].replace(tzinfo=timezone.utc)) for r in rows.collect()}
    assert got == {("2024-01-30", 1, first), ("2024-01-31", 2, first), ("2024-02-01", 30, second), ("2024-02-02", 40, second)}
    assert january and january <= set(rows.inputFiles())
    assert rows.columns == list(TABLES["daily_aggregates"].columns)


def test_a_rollup_before_any_is_empty(spark, store):
    assert store.read_rollup(spark, "dashboard_metrics").columns == list(TABLES["dashboard_metrics"].columns)


def sales(*rows):
    return [
        json.dumps({"transaction_id": i, "user_id": u, "category": c, "country": "X", "price": p, "quantity": 1, "transaction_status": s, "timestamp": f"{d} 10:00:00"})
        for i, u, c, p, s, d in rows
    ]


def run(spark, tmp_path, on_batch, **more):
    raw = folder_stream(spark, f"{tmp_path}/in")
    job.wait(job.start(raw, on_batch, f"{tmp_path}/checkpoint", available_now=True, **more))


def test_the_stream_keeps_the_days_up_to_date(spark, tmp_path, store):
    landings = [
        sales(("a", "u", "Toys", 5.0, "Success", "2024-01-01"), ("b", "v", "Books", 9.0, "Failed", "2024-01-02")),
        sales(("c", "w", "Books", 70.0, "Success", "2024-01-01"), ("d", "w", "Toys", 1.0, "Success", "2024-02-01")),
        sales(("e", "u", "Toys", 100.0, "Pending", "2024-01-01")),
    ]
    for n, records in enumerate(landings):
        land(f"{tmp_path}/in", f"{n}.json", *records)
        run(spark, tmp_path, BatchTables(store, "s", "exact", rollups_every=1))
        read = store.read(spark, "transactions", "s")
        wanted = {tuple(r) for r in daily.daily_aggregates(read, "exact").collect()}
        got = store.read_rollup(spark, "daily_aggregates").drop("created_at")
        assert {tuple(r) for r in got.select(*daily.daily_aggregates(read, "exact").columns).collect()} == wanted
    stamps = {r["date"]: r["created_at"] for r in store.read_rollup(spark, "daily_aggregates").collect()}
    assert stamps["2024-01-02"] < stamps["2024-02-01"] < stamps["2024-01-01"]  # as last touched
    shown = {r["metric_type"]: r["metric_value"] for r in store.read_rollup(spark, "dashboard_metrics").collect()}
    assert shown["total_transactions"] == 1.0 and shown["max_transaction_value"] == 100.0  # of the last batch
    # The last batch again, as after a failure: the states of the days stay what they are.
    batch = store.lookup(spark, "transactions", 2, "s").drop("batch_id")
    batch, wanted = spark.createDataFrame(batch.collect(), batch.schema), {tuple(r) for r in got.collect()}
    BatchTables(store, "s", "exact", rollups_every=1)(batch, 2)
    assert {tuple(r) for r in store.read_rollup(spark, "daily_aggregates").select(*got.columns).collect()} == wanted


def test_rollups_need_a_store_that_keeps_them(spark):
    with pytest.raises(ValueError, match="rollups"):
        BatchTables(ConnectorStore("x"), "s", rollups_every=1)
    with pytest.raises(ValueError, match="mode"):
        BatchTables(ConnectorStore("x"), "s", {"geo_metrics": "rough"})


def test_states_of_batches_merge_into_days(spark):
    rows = spark.range(4000).selectExpr(
        "cast(id % 700 as string) as user_id", "timestamp_seconds(1704067200 + (id % 5) * 86400) as event_time",
        "if(id % 3 = 0, null, concat('c', id % 4)) as category", "concat('x', id % 6) as country",
        "if(id % 50 = 0, null, cast(id % 97 as double) / 8) as transaction_value",
        "element_at(array('Success', 'Failed', null), cast(id % 3 as int) + 1) as transaction_status", "id % 7 as batch_id",
    )
    wanted = {tuple(r) for r in daily.daily_aggregates(rows, "exact").collect()}
    state = daily.daily_state(rows, ("batch_id",))
    names = daily.daily_aggregates(rows, "exact").columns
    assert {tuple(r) for r in daily.from_state(state).select(*names).collect()} == wanted
    some = daily.days_of(state, spark.sql("select date '2024-01-02' as day"))
    assert [r["date"] for r in daily.from_state(some).collect()] == ["2024-01-02"]


def test_bounded_counts_are_exact_below_the_bound_and_near_beyond(spark):
    rows = spark.range(60_000).selectExpr("if(id < 4000, 'small', 'large') as country", "'c' as city", "cast(id as string) as user_id", "1.0D as transaction_value", "'Success' as transaction_status")
    rows = rows.unionByName(rows.filter("user_id < '3'")).unionByName(rows.limit(1).withColumns({"country": F.lit("none"), "user_id": F.lit(None).cast("string")}))
    got = {r["country"]: r["unique_customers"] for r in metrics.geo_metrics(rows).collect()}
    assert got["small"] == 4000 and got["none"] == 0 and abs(got["large"] - 56_000) < 0.05 * 56_000


# --- what was read -----------------------------------------------------------


def test_lost_and_doubled_ranges(spark):
    ledger = [(0, "t", 0, 10, 20), (1, "t", 0, 20, 30), (2, "t", 0, 35, 40), (3, "t", 0, 12, 15), (4, "t", 0, 38, 50), (5, "t", 1, 0, 5), (6, "t", 1, 0, 5), (7, "t", 2, 7, 9)]
    frame = spark.createDataFrame(ledger, "batch_id long, source string, partition int, from_offset long, to_offset long")
    got = {tuple(r) for r in audit.offset_faults(frame).collect()}
    assert got == {
        ("t", 0, "doubled", 12, 15, 3), ("t", 0, "lost", 30, 35, 2), ("t", 0, "doubled", 38, 40, 4), ("t", 1, "doubled", 0, 5, 6)
    }
    assert audit.offset_faults(frame.limit(0)).count() == 0


def test_the_stream_keeps_a_ledger_and_damaged_texts(spark, tmp_path, store):
    bad = '{"transaction_id":"x","price":"cheap","quantity":1,"transaction_status":"Failed"}'
    land(f"{tmp_path}/in", "0.json", record("a"), bad, '{"transaction_id":"y"', "[]")
    run(spark, tmp_path, BatchTables(store, "s"), damaged=True, ledger=True)
    land(f"{tmp_path}/in", "1.json", record("b"))
    run(spark, tmp_path, BatchTables(store, "s"), damaged=True, ledger=True)
    ledger = store.read(spark, "read_ledger", "s")
    got = {(r["batch_id"], r["source"].rsplit("/", 1)[1], r["from_offset"], r["to_offset"], r["records"]) for r in ledger.collect()}
    assert got == {(0, "0.json", 0, 4, 4), (1, "1.json", 0, 1, 1)}
    assert audit.offset_faults(ledger).count() == 0
    texts = store.read(spark, "rejected_rows", "s").filter("reason = 'damaged record'")
    assert sorted(r["payload"] for r in texts.collect()) == sorted([bad, '{"transaction_id":"y"', "[]"])
    totals = store.read(spark, "transaction_metrics", "s").agg(F.sum("total_transactions")).first()[0]
    assert totals == 5  # damaged records are counted as before
    assert {r["transaction_id"] for r in store.read(spark, "transactions", "s").collect()} == {"a", "b", "x"}
    with pytest.raises(ValueError, match="ledger"):
        job.start(folder_stream(spark, f"{tmp_path}/in"), BatchTables(store, "s"), f"{tmp_path}/c", ledger=True, drop_repeats_within="1 hour")


def test_totals_cost_no_job_of_their_own(spark, store):
    """One job for the raw rows, which gives the totals, and the tables' jobs."""
    rows = spark.createDataFrame([("a", "u", "c", 5.0, "Success")], "transaction_id string, user_id string, category string, transaction_value double, transaction_status string")
    for name, dtype in TABLES["transactions"].columns.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(dtype))
    told = {}
    on_batch = BatchTables(store, "s", on_summary=lambda n, summary: told.update(summary))
    spark.sparkContext.setJobGroup("raw", "raw rows")
    on_batch._write_raw(rows, 1, on_batch._stamps(1))
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("raw")) == 1
    on_batch(rows, 0)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stored = store.lookup(spark, "transaction_metrics", 0, "s").first().asDict()
    wanted = metrics.transaction_metrics(rows).first().asDict()
    assert {k: stored[k] for k in wanted} == wanted and {k: wanted[k] for k in told} == told


@pytest.mark.parametrize("success,total", [(0, 7), (1, 3), (2, 3), (1, 200), (1, 40_000), (199, 200), (7, 7)])
def test_the_observed_rate_is_the_table_s(spark, store, success, total):
    rows = spark.range(total).selectExpr(f"if(id < {success}, 'Success', 'Failed') as transaction_status", "1.0D as transaction_value", "cast(id as string) as transaction_id")
    for name, dtype in TABLES["transactions"].columns.items():
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(dtype))
    on_batch = BatchTables(store, "s")
    row = on_batch._write_raw(rows, 1, on_batch._stamps(1))
    assert row["success_rate_percentage"] == metrics.transaction_metrics(rows).first()["success_rate_percentage"]


# --- owners and connectors ---------------------------------------------------


def test_one_of_two_owners_wins(spark, store):
    path = f"{store.root}/_owners/stream_id=s"
    assert folders.write_once(spark, path, "first") == "first" == folders.write_once(spark, path, "second")
    store.claim(spark, "s", "first")
    with pytest.raises(ValueError, match="belongs to query first"):
        store.claim(spark, "s", "second")
    # A writer that saw no file yet finds it when it renames its own.
    real = folders._at
    seen = []

    class Blind:
        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            if name == "exists" and not seen:
                return lambda *_: seen.append(1) or False
            return getattr(self.files, name)

    folders._at = lambda spark, path: (lambda files, where: (Blind(files), where))(*real(spark, path))
    try:
        assert folders.write_once(spark, path, "third") == "first"
    finally:
        folders._at = real


class _Held(DataSource):
    """A connector whose tables hold two streams of three batches."""

    @classmethod
    def name(cls):
        return "held"

    def schema(self):
        return "stream_id string, " + ", ".join(f"{n} {t}" for n, t in TABLES[self.options["table"]].columns.items())

    def reader(self, schema):
        return _HeldReader(schema)


class _HeldReader(DataSourceReader):
    def __init__(self, schema):
        self.names = schema.names

    def read(self, partition):
        for stream in ("s", "other"):
            for batch in range(3):
                row = {"stream_id": stream, "batch_id": batch, "payment_method": "UPI", "transaction_count": batch + (stream == "other") * 10}
                yield tuple(row.get(name) for name in self.names)


def test_a_connector_is_read_by_stream_and_batch(spark):
    spark.dataSource.register(_Held)
    store = ConnectorStore("held")
    assert counts(store.read(spark, PAYMENTS, "s")) == [(0, "UPI", 0), (1, "UPI", 1), (2, "UPI", 2)]
    assert counts(store.lookup(spark, PAYMENTS, 1, "other")) == [(1, "UPI", 11)]
    assert counts(store.latest(spark, PAYMENTS, "s")) == counts(store.read(spark, PAYMENTS, "s"))
    assert store.lookup(spark, PAYMENTS, 9, "s").count() == 0
    with pytest.raises(ValueError, match="not keyed by batch"):
        store.lookup(spark, "transactions", 1, "s")
