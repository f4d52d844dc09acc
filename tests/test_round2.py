"""Records that must not be lost, stored batches that must not be overwritten, exact money, null keys."""

import os
import subprocess
import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillwright.functions.measures import money_avg, money_sum, percentage
from tillwright.operators import logs
from tillwright.sinks.tables import FileStore
from tillwright.sources.readers import folder_stream
from tillwright.streaming import job
from tillwright.streaming.batches import BatchTables

ROOT = Path(__file__).resolve().parents[1]


def land(folder, name, *records, days_old=0):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(r + "\n" for r in records))
    then = path.stat().st_mtime - days_old * 86_400
    os.utime(path, (then, then))


def record(transaction_id, time="2024-01-01 00:00:00", status="Success"):
    shown = "null" if transaction_id is None else f'"{transaction_id}"'
    return f'{{"transaction_id":{shown},"transaction_status":"{status}","timestamp":"{time}","price":2.0,"quantity":1}}'


def run(spark, tmp_path, store=None, checkpoint="checkpoint", **more):
    raw = folder_stream(spark, f"{tmp_path}/in")
    store = store or FileStore(f"{tmp_path}/out")
    on_batch = BatchTables(store, "s", "exact")
    job.wait(job.start(raw, on_batch, f"{tmp_path}/{checkpoint}", available_now=True, **more))
    return store


def test_old_files_are_read(spark, tmp_path):
    land(f"{tmp_path}/in", "a.json", record("a"))
    run(spark, tmp_path)
    land(f"{tmp_path}/in", "b.json", record("b"), record("c"), days_old=60)
    store = run(spark, tmp_path)
    assert store.read(spark, "transactions", "s").count() == 3


def test_repeats_go_by_arrival(spark, tmp_path):
    land(f"{tmp_path}/in", "a.json", record("a", "2030-01-01 00:00:00"), record("b"), record("b"), record(None), record(None))
    run(spark, tmp_path, drop_repeats_within="1 hour")
    land(f"{tmp_path}/in", "b.json", record("c", "2001-01-01 00:00:00"), record("d", "bad"), record("a"))
    store = run(spark, tmp_path, drop_repeats_within="1 hour")
    metrics = store.read(spark, "transaction_metrics", "s").agg(F.sum("total_transactions")).first()[0]
    assert metrics == 6  # a, b, c, d and two without an id
    ids = sorted(r[0] for r in store.read(spark, "transactions", "s").select("transaction_id").collect())
    assert ids == ["a", "b", "c", "d"]


def test_another_checkpoint_cannot_overwrite_a_stream(spark, tmp_path):
    land(f"{tmp_path}/in", "a.json", record("a"))
    store = run(spark, tmp_path)
    run(spark, tmp_path)  # a restart is the same query
    land(f"{tmp_path}/in", "b.json", record("b"))
    with pytest.raises(Exception, match="belongs to query"):
        run(spark, tmp_path, checkpoint="another")
    assert [r[0] for r in store.read(spark, "transactions", "s").select("transaction_id").collect()] == ["a"]


def test_a_table_without_batches_is_empty(spark, tmp_path):
    store = FileStore(f"{tmp_path}/out")
    rows = store.read(spark, "zero_success_statuses", "s")
    assert rows.count() == 0 and "status_key" in rows.columns and "batch_id" in rows.columns


def test_null_keys_are_rejected_outside_the_stream(spark, tmp_path):
    store = FileStore(f"{tmp_path}/out")
    columns = "batch_id long, batch_time timestamp, payment_method string, transaction_count long, successful_revenue double, failed_count long, success_rate double, avg_transaction_value double"
    rows = spark.createDataFrame([(1, None, "Card", 1, 1.0, 0, 1.0, 1.0), (1, None, None, 2, 1.0, 0, 1.0, 1.0), (None, None, "COD", 3, 1.0, 0, 1.0, 1.0)], columns)
    store.replace_batches(rows, "payment_metrics")
    assert [r.payment_method for r in store.read(spark, "payment_metrics").collect()] == ["Card"]
    reasons = sorted(r.reason for r in store.read(spark, "rejected_rows").collect())
    assert reasons == ["null key: batch_id", "null key: payment_method"]


def test_alarm_of_the_null_batch(spark):
    rows = spark.createDataFrame([(None, "Failed"), (None, None), (1, "Pending"), (2, "Success")], "batch_id long, transaction_status string")
    got = {(r.batch_id, r.transaction_status) for r in logs.zero_success_statuses(rows).collect()}
    assert got == {(None, "Failed"), (None, None), (1, "Pending")}


def test_large_sums_hold_cents(spark):
    rows = spark.range(1_000_000).select((F.lit(123_456_789.0) + (F.col("id") % 100) / 100).alias("v"))
    wanted = 123_456_789 * 10**6 + 495_000
    for parts in (1, 3, 16):
        got = rows.repartition(parts).agg(money_sum(F.col("v")).alias("s"), money_avg(F.col("v")).alias("a")).first()
        assert got.s == float(wanted) and got.a == round(wanted / 10**6, 2)
    odd = rows.limit(3).unionAll(spark.sql("select double('NaN')"))
    assert str(odd.agg(money_sum(F.col("v"))).first()[0]) == "nan"
    assert rows.limit(0).agg(money_sum(F.col("v"))).first()[0] is None


def test_a_rate_below_a_tie_stays_below(spark):
    got = spark.sql("select 499999996L p, 10000000000000L w union all select 1, 3 union all select 0, 0 union all select 1, 200")
    rates = {r.p: r.r for r in got.select("p", percentage(F.col("p"), F.col("w")).alias("r")).filter("p > 0 and w != 200").collect()}
    assert rates == {499999996: 0.0, 1: 33.33}
    assert got.filter("w = 0").select(percentage(F.col("p"), F.col("w")).alias("r")).first().r is None


def test_rollups_replace_by_key(spark, tmp_path):
    store = FileStore(f"{tmp_path}/out")
    for value in (1.0, 2.0):
        rows = spark.createDataFrame([("a", value, "x"), (str(value), value, "y")], "metric_type string, metric_value double, metric_text string")
        store.replace_rollup(rows, "dashboard_metrics", datetime.now(timezone.utc))
    got = {r.metric_type: r.metric_value for r in store.read_rollup(spark, "dashboard_metrics").collect()}
    assert got == {"a": 2.0, "1.0": 1.0, "2.0": 2.0}


def test_the_documented_script_starts():
    done = subprocess.run([sys.executable, "run_job.py", "--help"], cwd=ROOT, capture_output=True, text=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, timeout=60)
    assert done.returncode == 0 and "--servers" in done.stdout and "--folder" in done.stdout
