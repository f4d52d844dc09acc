"""Keyed-table semantics and the stores."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tillwright.operators import keyed
from tillwright.schema import TABLES
from tillwright.session import scratch_folder
from tillwright.sinks.tables import ConnectorStore, FileStore, conform, rejects

PAYMENTS = TABLES["payment_metrics"]


def payments(spark, rows):
    """Rows of (batch_id, payment_method, transaction_count)."""
    frame = spark.createDataFrame(rows, "batch_id bigint, payment_method string, transaction_count bigint")
    for name, dtype in PAYMENTS.columns.items():
        if name not in frame.columns:
            frame = frame.withColumn(name, F.lit(None).cast(dtype))
    return conform(frame, "payment_metrics")


def counts(frame):
    return sorted(tuple(r) for r in frame.select("batch_id", "payment_method", "transaction_count").collect())


def test_latest_by_key(spark):
    rows = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "b"), ("a", 2, "c"), ("b", None, "only"), (None, 5, "x"), (None, 6, None)],
        "k string, v int, w string",
    )
    got = {tuple(r) for r in keyed.latest_by_key(rows, ["k"], ["v", "w"]).collect()}
    assert got == {("a", 2, "c"), ("b", None, "only"), (None, 6, None)}
    assert keyed.latest_by_key(rows, ["k"], ["v", "w"], ["w"]).columns == ["w"]


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(100_000).selectExpr("if(id % 3 = 0, -1, id) as k", "id as v")
    latest = keyed.latest_by_key(rows, ["k"], ["v"])
    assert latest.filter("k = -1").first()["v"] == 99_999
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_max_by")  # printed root first


def test_split_on_key(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (None, None)], "x int, y string")
    kept, rejected = keyed.split_on_key(rows, ["x", "y"])
    assert [tuple(r) for r in kept.collect()] == [(1, "a")]
    assert sorted(r["reason"] for r in rejected.collect()) == ["null key: x, y", "null key: y"]
    payload = rejects(rejected, "t", ["x", "y"]).filter("reason = 'null key: y'").first()["payload"]
    assert json.loads(payload) == {"x": 1, "y": None}


@pytest.fixture
def uncoalesced(spark):
    """Small test partitions are merged otherwise."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def test_clustering_splits_a_hot_batch_into_sorted_ranges(spark, uncoalesced):
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) as batch_id", "cast(hash(id) as string) as city")
    out = keyed.clustered(rows, ["batch_id", "city"]).withColumn("part", F.spark_partition_id())
    assert out.count() == 30_000
    ranges = (
        out.groupBy("part")
        .agg(F.min(F.struct("batch_id", "city")).alias("low"), F.max(F.struct("batch_id", "city")).alias("high"))
        .orderBy("low")
        .collect()
    )
    assert len(ranges) > 1
    assert all(tuple(a["high"]) < tuple(b["low"]) for a, b in zip(ranges, ranges[1:]))
    hot = out.filter("batch_id = 7").select("part").distinct().count()
    assert hot > 1
    for part in {r["part"] for r in ranges}:
        keys = [(r["batch_id"], r["city"]) for r in out.filter(f"part = {part}").collect()]
        assert keys == sorted(keys)


def test_replacing_a_batch_leaves_the_others(spark):
    store = FileStore(scratch_folder(spark, "t"))
    store.replace_batch(payments(spark, [(0, "UPI", 1), (0, "COD", 2)]), "payment_metrics", "s", 0)
    store.replace_batch(payments(spark, [(1, "UPI", 3)]), "payment_metrics", "s", 1)
    store.replace_batch(payments(spark, [(1, "UPI", 9)]), "payment_metrics", "other", 1)
    store.replace_batch(payments(spark, [(0, "UPI", 5)]), "payment_metrics", "s", 0)
    assert counts(store.read(spark, "payment_metrics", "s")) == [(0, "UPI", 5), (1, "UPI", 3)]
    assert counts(store.lookup(spark, "payment_metrics", 1, "other")) == [(1, "UPI", 9)]
    store.replace_batch(payments(spark, []), "payment_metrics", "s", 0)
    assert counts(store.read(spark, "payment_metrics", "s")) == [(1, "UPI", 3)]
    assert dict(store.read(spark, "payment_metrics", "s").dtypes) == PAYMENTS.columns


def test_replacing_many_batches(spark):
    store = FileStore(scratch_folder(spark, "t"))
    store.replace_batches(payments(spark, [(0, "UPI", 1), (1, "UPI", 2), (2, "COD", 3)]), "payment_metrics")
    store.replace_batches(payments(spark, [(1, "COD", 7), (3, "UPI", 8)]), "payment_metrics")
    want = [(0, "UPI", 1), (1, "COD", 7), (2, "COD", 3), (3, "UPI", 8)]
    assert counts(store.read(spark, "payment_metrics")) == want
    assert counts(store.lookup(spark, "payment_metrics", 2)) == [(2, "COD", 3)]


def test_lookup_reads_one_folder(spark):
    store = FileStore(scratch_folder(spark, "t"))
    store.replace_batches(payments(spark, [(n, "UPI", n) for n in range(20)]), "payment_metrics")
    files = store.lookup(spark, "payment_metrics", 11).inputFiles()
    assert files and all("/batch_id=11/" in file for file in files)


def test_append_adds(spark):
    store = FileStore(scratch_folder(spark, "t"), "json")
    for _ in range(2):
        store.append(payments(spark, [(0, "UPI", 1)]), "payment_metrics")
    assert counts(store.read(spark, "payment_metrics")) == [(0, "UPI", 1)] * 2


def test_conform_needs_every_column(spark):
    with pytest.raises(Exception, match="transaction_count|success"):
        conform(spark.createDataFrame([(1,)], "batch_id bigint"), "payment_metrics")


class _Listing(DataSource):
    """A connector that writes each task's rows, and the options it got, into a folder."""

    @classmethod
    def name(cls):
        return "listing"

    def schema(self):
        return "x int"

    def writer(self, schema, overwrite):
        return _ListingWriter(dict(self.options), overwrite)


class _ListingWriter(DataSourceWriter):
    def __init__(self, options, overwrite):
        self.options, self.overwrite = options, overwrite

    def write(self, rows):
        import uuid

        rows = [row.asDict() for row in rows]
        with open(f"{self.options['folder']}/{uuid.uuid4().hex}", "w") as out:
            json.dump({"rows": rows, "options": self.options, "overwrite": self.overwrite}, out, default=str)
        return WriterCommitMessage()


@pytest.mark.parametrize("with_stream", [False, True])
def test_connector_gets_table_options_and_appends(spark, tmp_path, with_stream):
    spark.dataSource.register(_Listing)
    options = {"folder": str(tmp_path), "keyspace": "shop"}
    store = ConnectorStore("listing", options, write_stream_id=with_stream)
    store.replace_batch(payments(spark, [(4, "UPI", 1)]), "payment_metrics", "s", 4)
    written = [json.load(open(file)) for file in glob.glob(os.path.join(tmp_path, "*"))]
    rows = [row for part in written for row in part["rows"]]
    assert [(r["batch_id"], r["payment_method"]) for r in rows] == [(4, "UPI")]
    assert ("stream_id" in rows[0]) == with_stream
    assert all(part["options"]["table"] == "payment_metrics" for part in written)
    assert all(part["options"]["keyspace"] == "shop" and not part["overwrite"] for part in written)
