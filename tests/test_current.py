"""The newest row of each key, merged batch by batch."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_round2 import land, record
from tests.test_tables import payments
from tillwright.plans import catalog, oracle
from tillwright.schema import TABLES
from tillwright.session import scratch_folder
from tillwright.sinks import folders
from tillwright.sinks.current import CurrentRows
from tillwright.sinks.tables import ConnectorStore, FileStore, conform
from tillwright.sources.readers import folder_stream
from tillwright.streaming import job
from tillwright.streaming.batches import BatchTables

TABLE = "transactions"


@pytest.fixture
def store(spark):
    return FileStore(scratch_folder(spark, "c"))


def purchases(spark, rows):
    """Rows of (transaction_id, quantity)."""
    frame = spark.createDataFrame(rows, "transaction_id string, quantity int")
    for name, dtype in TABLES[TABLE].columns.items():
        if name not in frame.columns:
            frame = frame.withColumn(name, F.lit(None).cast(dtype))
    return conform(frame, TABLE)


def shown(frame):
    return sorted((r["transaction_id"], r["batch_id"], r["quantity"]) for r in frame.collect())


def newest(batches):
    """What a keyed store would hold of {batch_id: rows}."""
    found = {}
    for batch, rows in sorted(batches.items()):
        for key, quantity in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
            found[key] = (key, batch, quantity)
    return sorted(found.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_merges_in_any_order_and_again_agree_with_brute_force(spark, store, seed):
    rng, held = random.Random(seed), {}
    current = CurrentRows(store, TABLE, "s", buckets=4)
    for step in range(9):
        batch = rng.randrange(5)
        rows = [(f"k{rng.randrange(8)}", rng.choice([None, 1, 2, 3])) for _ in range(rng.choice([0, 1, 5]))]
        held[batch] = rows
        store.replace_batch(purchases(spark, rows), TABLE, "s", batch)
        current.merge(spark, batch)
        assert shown(current.read(spark)) == newest(held), step
    assert shown(store.latest(spark, TABLE, "s")) == newest(held)


def test_a_merge_that_fails_costs_nothing_but_time(spark, store, monkeypatch):
    current = CurrentRows(store, TABLE, "s", buckets=4)
    for batch, rows in enumerate(([("a", 1), ("b", 1)], [("a", 2)])):
        store.replace_batch(purchases(spark, rows), TABLE, "s", batch)
        if batch == 0:
            current.merge(spark, batch)
    with monkeypatch.context() as broken:

        def lost(rows, mode):
            # As if the driver died between the removal of the old files and the arrival of the new.
            folders.delete(spark, f"{current.folder}/bucket={current.get(spark, transaction_id='a').select(current._bucket('transaction_id')).first()[0]}")
            raise OSError("lost")

        broken.setattr(store, "writer", lost)
        with pytest.raises(OSError):
            current.merge(spark, 1)
    assert shown(current.read(spark)) == [("a", 1, 2), ("b", 0, 1)] == shown(current.get(spark, transaction_id="a")) + [("b", 0, 1)]
    current.merge(spark, 1)
    assert current._whole(spark) and shown(current.read(spark)) == [("a", 1, 2), ("b", 0, 1)]


def test_reads_do_not_shuffle_and_merges_touch_their_buckets(spark, store):
    current = CurrentRows(store, TABLE, "s", buckets=8)
    store.replace_batch(purchases(spark, [(f"k{i}", i) for i in range(200)]), TABLE, "s", 0)
    current.merge(spark, 0)
    before = set(current.read(spark).inputFiles())
    assert len(before) == 8
    assert "Exchange" not in current.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in store.latest(spark, TABLE, "s")._jdf.queryExecution().executedPlan().toString()
    one = current.get(spark, transaction_id="k7")
    assert shown(one) == [("k7", 0, 7)] and "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()
    store.replace_batch(purchases(spark, [("k7", -7)]), TABLE, "s", 1)
    current.merge(spark, 1)
    assert len(before & set(current.read(spark).inputFiles())) == 7
    assert shown(current.get(spark, transaction_id="k7")) == [("k7", 1, -7)]
    assert current.get(spark, transaction_id="nobody").isEmpty()
    with pytest.raises(ValueError):
        current.get(spark, user_id="k7")
    # Another number of buckets takes in all batches at the first merge.
    other = CurrentRows(store, TABLE, "s", buckets=2)
    other.merge(spark, 1)
    assert shown(other.read(spark)) == shown(current.read(spark))


def test_a_key_that_holds_most_rows_and_tables_keyed_by_batch(spark, store):
    current = CurrentRows(store, TABLE, "s", buckets=4)
    assert current.read(spark).isEmpty()
    store.replace_batch(purchases(spark, [("hot", i) for i in range(5000)] + [("cold", 1)]), TABLE, "s", 3)
    current.merge(spark, 3)
    assert shown(current.read(spark)) == [("cold", 3, 1), ("hot", 3, 4999)]
    by_batch = CurrentRows(store, "payment_metrics", "s", buckets=4)
    for batch in (0, 1, 1):
        store.replace_batch(payments(spark, [(batch, "UPI", batch), (batch, "COD", 5)]), "payment_metrics", "s", batch)
        by_batch.merge(spark, batch)
    got = sorted((r["batch_id"], r["payment_method"], r["transaction_count"]) for r in by_batch.read(spark).collect())
    assert got == [(0, "COD", 5), (0, "UPI", 0), (1, "COD", 5), (1, "UPI", 1)]


def test_the_stream_keeps_current_rows(spark, tmp_path, store):
    for n, records in enumerate(([record("a"), record("b")], [record("a").replace('"quantity":1', '"quantity":2')])):
        land(f"{tmp_path}/in", f"{n}.json", *records)
        raw = folder_stream(spark, f"{tmp_path}/in")
        job.wait(job.start(raw, BatchTables(store, "s", current=[TABLE]), f"{tmp_path}/checkpoint", available_now=True))
        current = CurrentRows(store, TABLE, "s")
        assert current._whole(spark) and shown(current.read(spark)) == shown(store.latest(spark, TABLE, "s"))
    assert shown(current.read(spark)) == [("a", 1, 2), ("b", 0, 1)]
    with pytest.raises(ValueError):
        BatchTables(ConnectorStore("parquet"), "s", current=[TABLE])


def test_the_query_has_sql():
    assert "current_rows" in catalog.queries() and "current_rows" in oracle.oracle_sql()
