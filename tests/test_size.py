"""What keeps tasks and shuffles small on large tables."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tillwright import fixtures
from tillwright.plans import catalog
from tillwright.session import FIRST_PARTITIONS, configure, scratch_folder
from tillwright.sinks.publish import publish_folder
from tillwright.sinks.tables import FileStore

SF = "/root/testdata/sf0.001"
FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_first_partitions_do_not_follow_a_small_cluster(spark):
    one = spark.newSession()
    one.conf.set("spark.sql.shuffle.partitions", "4")
    configure(one)
    assert int(one.conf.get(FIRST)) >= FIRST_PARTITIONS
    many = spark.newSession()
    many.conf.set("spark.sql.shuffle.partitions", str(FIRST_PARTITIONS + 5))
    configure(many)
    assert int(many.conf.get(FIRST)) == FIRST_PARTITIONS + 5


def test_buyer_fields_are_made_after_the_joins(spark):
    plan = fixtures.tx_records(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("@example.com") < plan.index("Join")
    assert plan.count("@example.com") == 1


def test_stored_days_are_made_once(spark, monkeypatch):
    seen = []
    stored = FileStore.replace_rollup
    monkeypatch.setattr(FileStore, "replace_rollup", lambda self, rows, *rest: (seen.append(plan_of(rows)), stored(self, rows, *rest)))
    catalog.daily_stored(spark, SF)
    assert seen and all("InMemoryTableScan" in plan for plan in seen)


def test_persisted_results_are_merged_into_few_partitions(spark):
    rows = spark.range(100).groupBy("id").count().persist()
    try:
        rows.count()
        assert rows.rdd.getNumPartitions() < 100
    finally:
        rows.unpersist()


def test_appended_rows_come_back_with_those_that_have_no_key(spark):
    store = FileStore(scratch_folder(spark, "appended"))
    rows = fixtures.tx(spark, SF).limit(5).withColumn("processed_at", F.lit(None).cast("timestamp"))
    rows = rows.unionByName(rows.limit(1).withColumn("transaction_id", F.lit(None).cast("string")))
    store.append(rows, "transactions")
    assert store.read(spark, "transactions").count() == 5
    assert store.appended(spark, "transactions").filter("transaction_id IS NULL").count() == 1


def test_rejected_tables_join_once(spark, monkeypatch):
    made = []
    replaced = FileStore.replace_batches
    monkeypatch.setattr(FileStore, "replace_batches", lambda self, rows, table: (made.append(plan_of(rows)), replaced(self, rows, table)))
    catalog.rejected_tables(spark, SF)
    assert made and not any("Join" in plan for plan in made)


def test_published_records_are_compressed(spark):
    folder = scratch_folder(spark, "published")
    publish_folder(spark.createDataFrame([('{"a": 1}',)], "value string"), folder)
    assert [row["name"].endswith(".gz") for row in spark.read.text(folder).select(F.input_file_name().alias("name")).collect()] == [True]
    assert spark.read.text(folder).first()["value"] == '{"a": 1}'


def test_a_year_is_read_without_the_others(spark, monkeypatch):
    plans = []
    replaced = FileStore.replace_batch
    monkeypatch.setattr(FileStore, "replace_batch", lambda self, rows, *rest: (plans.append(plan_of(rows)), replaced(self, rows, *rest))[1])
    catalog.current_rows(spark, SF)
    assert plans and all(re.search(r"PartitionFilters: \[[^\]]*_year", plan) for plan in plans)


def test_parts_join_before_orders(spark):
    """Rows of the second shuffle carry the part's three fields, not the order's and the buyer's."""
    plan = fixtures.tx_records(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    last, first = re.search(r"\(l_orderkey#\d+L = o_orderkey", plan), re.search(r"\(l_partkey#\d+L = p_partkey", plan)
    assert last.start() < first.start()


def test_bytes_of_the_wire_are_not_encoded_again(spark):
    wire = catalog._wire(spark, SF)
    assert dict(wire.dtypes) == {"value": "binary"} and "ncode" not in plan_of(wire)
    text = '{"a":"Zoë 😀"}'
    row = spark.createDataFrame([(text,)], "value string").select(F.col("value").cast("binary").alias("value")).first()
    assert bytes(row["value"]) == text.encode()


def test_repeated_records_are_made_once(spark, monkeypatch):
    sent = []

    def published(records, folder):
        sent.append((plan_of(records), records.count(), records.distinct().count()))
        publish_folder(records, folder)

    monkeypatch.setattr(catalog, "publish_folder", published)
    catalog.stream_repeats(spark, SF)
    assert len(sent) == 2
    for plan, rows, different in sent:
        assert plan.count("events.parquet") == 1 and rows == 2 * different > 0
