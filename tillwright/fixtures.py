"""Transaction views over the test tables (FIXTURES.md).

Which small side to broadcast is left to the optimizer's size check. The joins of the two large
tables, lineitem and events, ask for a sort-merge join, which spills and splits skewed keys at any
size: the check goes by compressed file sizes, and may broadcast a table that is several times as
large in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.schema import EVENT_TIME_FORMAT, FAILED, PENDING, RECORD_FIELDS, SUCCESS
from tillwright.sources.decode import derive

# Domains of `tx` for the domain check; price, age and product are narrower than the data.
TX_DOMAINS = {
    "age": (18, 65),
    "gender": ["Male", "Female", "Other"],
    "product_name": ["blue bolt", "hot gear", "red widget", "small gizmo", "small ring"],
    "category": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL"],
    "quantity": (1, 5),
    "price": (900.0, 950.0),
    "payment_method": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "transaction_status": ["Success", "Failed", "Pending"],
}

# The columns used of each table. Declared, as inferring a schema is a job per table.
_COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


# The buyer fields of a record. They are made of ``_buyers`` after the joins, so that shuffles carry what they are made of.
_BUYER_FIELDS = {
    "user_id": "cast(c_custkey as string)",
    "user_name": "c_name",
    "email": "concat('user', c_custkey, '@example.com')",
    "age": "cast(18 + c_custkey % 53 as int)",
    "gender": "case c_custkey % 3 when 0 then 'Male' when 1 then 'Female' else 'Other' end",
    "country": "n_name",
    "city": "c_mktsegment",
}


def _buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the buyer fields are made of, one row per customer."""
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "c_name", "n_name", "c_mktsegment")


def _records(rows: DataFrame, derived: dict[str, str]) -> DataFrame:
    """The record fields in order, by expression where there is one and by name otherwise."""
    derived = {**_BUYER_FIELDS, **derived}
    return rows.selectExpr(*[f"{derived.get(name, name)} as `{name}`" for name in RECORD_FIELDS])


def tx_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record fields, one row per lineitem row.

    Buyers join the orders before the lineitem rows do, so the large side is shuffled for two keys
    (order and part) rather than three. Parts come first, as they add less to the rows of the second
    shuffle than orders with their buyers.
    """
    buyers = _buyers(spark, sf_dir)
    orders = _table(spark, sf_dir, "orders")
    orders = orders.join(buyers, orders.o_custkey == buyers.c_custkey)
    lines = _table(spark, sf_dir, "lineitem")
    parts = _table(spark, sf_dir, "part")
    return _records(
        lines.join(parts, lines.l_partkey == parts.p_partkey)
        .hint("merge")
        .join(orders, lines.l_orderkey == orders.o_orderkey),
        {
            "transaction_id": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
            "date_format(l_shipdate, 'yyyy-MM-dd'))",
            "product_id": "cast(p_partkey as string)",
            "product_name": "p_name",
            "category": "case when l_partkey % 101 <> 0 then p_type end",
            "quantity": "cast(cast(l_quantity - 1 as int) % 5 + 1 as int)",
            "price": "p_retailprice",
            "payment_method": "o_orderpriority",
            "transaction_status": "case when l_partkey % 97 = 0 then null when l_partkey % 89 = 0 then '' "
            f"when o_orderstatus = 'F' then '{SUCCESS}' when o_orderstatus = 'O' then '{PENDING}' "
            f"when o_orderstatus = 'P' then '{FAILED}' end",
            "timestamp": f"date_format(l_shipdate, '{EVENT_TIME_FORMAT}')",
        },
    )


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(tx_records(spark, sf_dir))


def event_records(
    spark: SparkSession, sf_dir: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """The record fields, one row per event, optionally of the days from ``since`` to before ``until``."""
    buyers = _buyers(spark, sf_dir)
    events = _table(spark, sf_dir, "events")
    if since is not None:
        events = events.filter(f"ts >= timestamp_ntz '{since}'")
    if until is not None:
        events = events.filter(f"ts < timestamp_ntz '{until}'")
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    return _records(
        events.hint("merge").join(buyers, events.user_id == buyers.c_custkey),
        {
            "transaction_id": "cast(event_id as string)",
            "product_id": "cast(k as string)",
            "product_name": "cast(k as string)",
            "category": "event_type",
            "quantity": "cast(k % 5 + 1 as int)",
            "price": "value",
            "payment_method": "case k % 5 when 0 then 'Credit Card' when 1 then 'Debit Card' "
            "when 2 then 'UPI' when 3 then 'Net Banking' else 'COD' end",
            "transaction_status": f"case when event_id % 10 < 7 then '{SUCCESS}' "
            f"when event_id % 10 < 9 then '{FAILED}' else '{PENDING}' end",
            "timestamp": f"date_format(ts, '{EVENT_TIME_FORMAT}')",
        },
    )


def event_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(event_records(spark, sf_dir))
