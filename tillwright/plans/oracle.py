"""SQL equivalents of the registered queries, for DuckDB over the same tables.

Clock columns are left out, and sketches have no exact equivalent.
"""

from __future__ import annotations

from textwrap import dedent

from tillwright.schema import RECORD_FIELDS

def _half_up(number: str, places: int = 2) -> str:
    """Round half away from zero. In decimals, since on a double ``round`` scales in binary and
    takes ties such as 16.435 down."""
    return f"CAST(round(CAST({number} AS DECIMAL(28, 8)), {places}) AS DOUBLE)"


def _money(column: str) -> str:
    """A sum in decimals, which is exact and the same in any order."""
    return f"sum(CAST({column} AS DECIMAL(28, 8)))"


def _rate(part: str, whole: str, places: int = 2) -> str:
    """Percent of two counts, half up in integers."""
    scale = 10**places
    return f"CAST(({part} * {200 * scale} + {whole}) // nullif(2 * {whole}, 0) AS DOUBLE) / {scale}"


_BUYERS = """
buyers AS (
  SELECT c_custkey,
         CAST(c_custkey AS VARCHAR) AS user_id,
         c_name AS user_name,
         'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         CAST(18 + c_custkey % 53 AS INTEGER) AS age,
         CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender,
         n_name AS country,
         c_mktsegment AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

_DERIVED = """
  SELECT *,
         CAST(strptime("timestamp", '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS event_time,
         price * quantity AS transaction_value,
         transaction_status = 'Success' AS ok,
         transaction_status = 'Failed' AS failed,
         CASE WHEN transaction_status = 'Success' THEN price * quantity ELSE 0 END AS settled"""

_TX = f"""{_BUYERS},
tx_records AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
           || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-'
           || strftime(l_shipdate, '%Y-%m-%d') AS transaction_id,
         user_id, user_name, email, age, gender, country, city,
         CAST(p_partkey AS VARCHAR) AS product_id,
         p_name AS product_name,
         CASE WHEN l_partkey % 101 <> 0 THEN p_type END AS category,
         CAST(CAST(l_quantity - 1 AS INTEGER) % 5 + 1 AS INTEGER) AS quantity,
         p_retailprice AS price,
         o_orderpriority AS payment_method,
         CASE WHEN l_partkey % 97 = 0 THEN NULL
              WHEN l_partkey % 89 = 0 THEN ''
              WHEN o_orderstatus = 'F' THEN 'Success'
              WHEN o_orderstatus = 'O' THEN 'Pending'
              WHEN o_orderstatus = 'P' THEN 'Failed' END AS transaction_status,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS "timestamp"
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN buyers ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
),
tx AS ({_DERIVED}
  FROM tx_records
)"""

_EVENTS = f"""{_BUYERS},
keyed_events AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
event_records AS (
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         b.user_id, user_name, email, age, gender, country, city,
         CAST(k AS VARCHAR) AS product_id,
         CAST(k AS VARCHAR) AS product_name,
         event_type AS category,
         CAST(k % 5 + 1 AS INTEGER) AS quantity,
         value AS price,
         CASE k % 5 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'Debit Card' WHEN 2 THEN 'UPI'
                    WHEN 3 THEN 'Net Banking' ELSE 'COD' END AS payment_method,
         CASE WHEN event_id % 10 < 7 THEN 'Success' WHEN event_id % 10 < 9 THEN 'Failed'
              ELSE 'Pending' END AS transaction_status,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp"
  FROM keyed_events e JOIN buyers b ON e.user_id = b.c_custkey
),
event_tx AS ({_DERIVED}
  FROM event_records
)"""

_RECORD = ", ".join(f'"{name}"' for name in RECORD_FIELDS)

_STATS = f"""
         count(*) AS total_transactions,
         count(*) FILTER (WHERE ok) AS successful_transactions,
         count(*) FILTER (WHERE failed) AS failed_transactions,
         count(*) FILTER (WHERE transaction_status = 'Pending') AS pending_transactions,
         count(*) FILTER (WHERE transaction_status IS NULL OR transaction_status = '') AS unknown_status,
         {_half_up(_money("settled"))} AS total_revenue,
         {_half_up(_money("transaction_value") + " / count(transaction_value)")} AS avg_transaction_value,
         {_half_up("max(transaction_value)")} AS max_transaction_value,
         {_half_up("min(transaction_value)")} AS min_transaction_value,
         CASE WHEN count(*) > 0
              THEN {_rate("count(*) FILTER (WHERE ok)", "count(*)")}
              ELSE 0.0e0 END AS success_rate_percentage"""

_USERS = f"""
         count(DISTINCT user_id) AS unique_users,
         {_half_up("avg(age)")} AS avg_customer_age,
         count(*) FILTER (WHERE gender = 'Male') AS male_customers,
         count(*) FILTER (WHERE gender = 'Female') AS female_customers,
         count(*) FILTER (WHERE gender = 'Other') AS other_gender_customers,
         {_half_up(_money("transaction_value") + " / nullif(count(DISTINCT user_id), 0)")} AS avg_spend_per_user"""

_CATEGORY = f"""
         count(*) AS order_count,
         {_half_up(_money("transaction_value"))} AS category_revenue,
         {_half_up(_money("transaction_value") + " / count(transaction_value)")} AS avg_order_value,
         count(DISTINCT product_id) AS unique_products,
         count(DISTINCT user_id) AS unique_customers"""

_PAYMENT = f"""
         count(*) AS transaction_count,
         {_half_up(_money("settled"))} AS successful_revenue,
         count(*) FILTER (WHERE failed) AS failed_count,
         {_half_up(_money("transaction_value") + " / count(transaction_value)")} AS avg_transaction_value,
         {_rate("(count(*) - count(*) FILTER (WHERE failed))", "count(*)")} AS success_rate"""

_GEO = f"""
         count(*) AS transaction_count,
         {_half_up(_money("settled"))} AS revenue,
         count(DISTINCT user_id) AS unique_customers,
         {_half_up(_money("transaction_value") + " / count(transaction_value)")} AS avg_transaction_value"""

_FAILED = """transaction_id, user_id, user_name, email, product_name, payment_method,
         transaction_value, country, city, event_time"""

_ALERTS = "transaction_id, user_id, user_name, product_name, transaction_value, payment_method, country"


def _tx(select: str) -> str:
    return f"WITH {_TX.strip()}\n{dedent(select).strip()}"


def _batches(width_seconds: int, source: str = "event_tx") -> str:
    return f"""
batches AS (
  SELECT *, epoch_us(event_time) // {width_seconds * 1_000_000} AS batch_id FROM {source}
)"""


def _replay(select: str, width_seconds: int = 86_400) -> str:
    return f"WITH {_EVENTS.strip()},{_batches(width_seconds)}\n{dedent(select).strip()}"


def _interval(stats: str, by: str = "", width_seconds: int = 86_400) -> str:
    keys = f"batch_id, {by}" if by else "batch_id"
    start = f"make_timestamp(batch_id * {width_seconds * 1_000_000}) AS batch_time"
    return _replay(f"SELECT {keys}, {start}, {stats.strip()}\nFROM batches GROUP BY {keys}", width_seconds)


# Each landing of events is one micro-batch; number 1 is empty.
_STREAM = f"""WITH {_EVENTS.strip()},
stream AS (
  SELECT *, CAST(CASE WHEN event_time < TIMESTAMP '2024-01-11' THEN 0
                      WHEN event_time < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END AS BIGINT) AS batch_id
  FROM event_tx
)"""


def _stream(stats: str, by: str = "") -> str:
    keys = f"batch_id, {by}" if by else "batch_id"
    return f"{_STREAM}\nSELECT {keys}, {stats.strip()}\nFROM stream GROUP BY {keys}"


def _unpivot(rows: list[tuple[str, str]], name: str, value: str) -> str:
    """One SELECT per (label, expression) over a one-row subquery ``m``."""
    return "\nUNION ALL ".join(f"SELECT '{label}' AS {name}, {sql} AS {value} FROM m" for label, sql in rows)


_DASHBOARD = [
    ("total_transactions", "{:.0f}"),
    ("successful_transactions", "{:.0f}"),
    ("failed_transactions", "{:.0f}"),
    ("pending_transactions", "{:.0f}"),
    ("unknown_status", "{:.0f}"),
    ("success_rate_percentage", "{:.2f}%"),
    ("total_revenue", "{:.2f}"),
    ("avg_transaction_value", "{:.2f}"),
    ("max_transaction_value", "{:.2f}"),
    ("min_transaction_value", "{:.2f}"),
]


def _dashboard(extra: str = "") -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS metric_type, CAST({name} AS DOUBLE) AS metric_value, "
        f"format('{pattern}', CAST({name} AS DOUBLE)) AS metric_text{extra} FROM m"
        for name, pattern in _DASHBOARD
    )


_DAY = "strftime(event_time, '%Y-%m-%d')"


def _top(name: str, revenue: str, alias: str) -> str:
    return f"""
SELECT "date", {name} AS {alias} FROM (
  SELECT *, row_number() OVER (PARTITION BY "date" ORDER BY {name} IS NULL, revenue DESC, {name}) AS place
  FROM (SELECT {_DAY} AS "date", {name}, {_half_up(_money(revenue))} AS revenue FROM tx GROUP BY 1, 2)
) WHERE place = 1"""


_DOMAINS = [
    ("age", "NOT age BETWEEN 18 AND 65"),
    ("gender", "gender NOT IN ('Male', 'Female', 'Other')"),
    ("product_name", "product_name NOT IN ('blue bolt', 'hot gear', 'red widget', 'small gizmo', 'small ring')"),
    ("category", "category NOT IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL')"),
    ("quantity", "NOT quantity BETWEEN 1 AND 5"),
    ("price", "NOT price BETWEEN 900 AND 950"),
    (
        "payment_method",
        "payment_method NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')",
    ),
    ("transaction_status", "transaction_status NOT IN ('Success', 'Failed', 'Pending')"),
]
_MISSING = [(name, f'"{name}" IS NULL') for name in RECORD_FIELDS]
_MISSING.append(("any", " OR ".join(sql for _, sql in _MISSING)))


def _counted(conditions: list[tuple[str, str]], value: str) -> str:
    counts = ", ".join(f'count(*) FILTER (WHERE {sql}) AS "{name}"' for name, sql in conditions)
    rows = _unpivot([(name, f'"{name}"') for name, _ in conditions], "field", value)
    return f"WITH {_TX.strip()},\nm AS (SELECT {counts} FROM tx)\n{rows}"


# Some products' transactions without a payment method, city or id; see the catalog.
_HOLEY = """
holey AS (
  SELECT * REPLACE (
    CASE WHEN CAST(product_id AS BIGINT) % 103 <> 0 THEN payment_method END AS payment_method,
    CASE WHEN CAST(product_id AS BIGINT) % 107 <> 0 THEN city END AS city,
    CASE WHEN CAST(product_id AS BIGINT) % 109 <> 0 THEN transaction_id END AS transaction_id)
  FROM tx
)"""
_REJECTED_FIELDS = [
    ("order_count", "BIGINT"), ("category_revenue", "DOUBLE"), ("avg_order_value", "DOUBLE"), ("unique_products", "BIGINT"),
    ("unique_customers", "BIGINT"), ("transaction_count", "BIGINT"), ("successful_revenue", "DOUBLE"), ("failed_count", "BIGINT"),
    ("success_rate", "DOUBLE"), ("revenue", "DOUBLE"), ("avg_transaction_value", "DOUBLE"), ("transaction_id", "VARCHAR"),
    ("user_id", "VARCHAR"), ("product_name", "VARCHAR"), ("transaction_value", "DOUBLE"), ("payment_method", "VARCHAR"),
    ("country", "VARCHAR"), ("city", "VARCHAR"), ("category", "VARCHAR"),
]


def _rejected_tables() -> str:
    """Rows of each keyed table whose key has a null, per year, with their payload; equal ones are numbered."""
    year = "batch_id"
    city_reason = "'null key: city'"
    parts = {
        "category_metrics": (year, "'null key: category'", f"category, {_CATEGORY} FROM batches WHERE category IS NULL GROUP BY batch_id, category"),
        "payment_metrics": (year, "'null key: payment_method'", f"payment_method, {_PAYMENT} FROM batches WHERE payment_method IS NULL GROUP BY batch_id, payment_method"),
        "geo_metrics": (year, city_reason, f"country, city, {_GEO} FROM batches WHERE city IS NULL GROUP BY batch_id, country, city"),
        "failed_transactions": (year, "'null key: transaction_id'", f"{_FAILED} FROM batches WHERE failed AND transaction_id IS NULL"),
        "high_value_alerts": (year, "'null key: transaction_id'", f"{_ALERTS} FROM batches WHERE transaction_value > 1000 AND transaction_id IS NULL"),
        "transactions": ("CAST(NULL AS BIGINT) AS batch_id", "'null key: transaction_id'", f"{_RECORD}, transaction_value FROM batches WHERE transaction_id IS NULL"),
    }
    shown = ", ".join(f'CAST("{name}" AS {kind}) AS "{name}"' for name, kind in _REJECTED_FIELDS)
    # Rows are told apart by all that the store keeps of them.
    every = "\nUNION ALL BY NAME ".join(
        f"SELECT *, row_number() OVER (PARTITION BY r) AS \"copy\" FROM (SELECT {batch}, '{table}' AS table_name, {reason} AS reason, {body}) r"
        for table, (batch, reason, body) in parts.items()
    )
    return f"""WITH {_TX.strip()},{_HOLEY},{_batches(365 * 86_400, "holey")},
every AS ({every})
SELECT batch_id, table_name, reason, "copy", {shown} FROM every"""


def _rejects_replayed() -> str:
    return f"""WITH {_TX.strip()},{_batches(365 * 86_400, "tx")},
made AS (SELECT batch_id, category, {_CATEGORY} FROM batches GROUP BY batch_id, category),
kept AS (SELECT batch_id, count(*) AS kept_rows FROM made WHERE category IS NOT NULL GROUP BY batch_id)
SELECT batch_id, 'category_metrics' AS table_name, 'null key: category' AS reason, 1::BIGINT AS "copy",
       order_count, category_revenue, avg_order_value, unique_products, unique_customers, kept_rows
FROM made JOIN kept USING (batch_id) WHERE category IS NULL"""


def _offset_gaps() -> str:
    return f"""WITH {_EVENTS.strip()},{_batches(3600)},
ledger AS (
  SELECT batch_id, CAST(CAST(transaction_id AS BIGINT) % 4 AS INTEGER) AS "partition",
         min(CAST(transaction_id AS BIGINT) // 4) AS low, max(CAST(transaction_id AS BIGINT) // 4) + 1 AS high
  FROM batches GROUP BY 1, 2),
read AS (
  SELECT * FROM ledger WHERE batch_id % 11 <> 3
  UNION ALL SELECT * REPLACE (batch_id + 1000000 AS batch_id) FROM ledger WHERE batch_id % 13 = 5),
ranges AS (
  SELECT *, max(high) OVER (PARTITION BY "partition" ORDER BY low, high, batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS behind
  FROM read)
SELECT 'events' AS source, "partition", CASE WHEN low > behind THEN 'lost' ELSE 'doubled' END AS fault,
       CASE WHEN low > behind THEN behind ELSE low END AS from_offset,
       CASE WHEN low > behind THEN low ELSE least(high, behind) END AS to_offset, batch_id
FROM ranges WHERE low > behind OR (behind IS NOT NULL AND low < least(high, behind))"""


def _irregular(damaged: bool) -> str:
    """What is left of each damaged record; the texts are made as the catalog makes them."""
    left = {"transaction_id": (2, 3, 4), "price": (3, 4), "quantity": (4,)}
    fields = []
    for name in RECORD_FIELDS:
        field = f"CASE WHEN quantity IN {(*left.get(name, (4,)), 0)} THEN \"{name}\" END"
        if name == "category":
            field = "CASE quantity WHEN 2 THEN CAST(age AS VARCHAR) WHEN 4 THEN category END"
        fields.append(f'{field} AS "{name}"')
    whole = f"(SELECT CAST(to_json(r) AS VARCHAR) FROM (SELECT {_RECORD}) r)"
    text = f"""
        CASE quantity WHEN 1 THEN left({whole}, length({whole}) - 8)
             WHEN 2 THEN '{{"transaction_id":"' || transaction_id || '","price":"x","quantity":"' || quantity || '","category":' || age || '}}'
             WHEN 3 THEN CAST(json_object('transaction_id', transaction_id, 'quantity', quantity + 0.5e0, 'price', price) AS VARCHAR)
             WHEN 5 THEN '' END AS damaged_record"""
    return _tx(f"SELECT {', '.join(fields)}{', ' + text if damaged else ''} FROM tx_records")


def oracle_sql() -> dict[str, str]:
    sql = _oracle_sql()
    # The stored rollups are the computed ones.
    same = {
        "daily_stored": "daily_aggregates",
        "daily_aggregates_bounded": "daily_aggregates",
        "dashboard_stored": "dashboard_metrics",
        "geo_metrics_bounded": "geo_metrics",
    }
    # Days of the events, whatever batches they came in.
    of_events = sql["daily_aggregates"].replace(_TX.strip(), f"{_EVENTS.strip()},\ntx AS (SELECT * FROM event_tx)")
    return sql | {name: sql[twin] for name, twin in same.items()} | {"daily_incremental": of_events}


def _oracle_sql() -> dict[str, str]:
    return {
        "decode_value": _tx(f"SELECT CAST(to_json(r) AS VARCHAR) AS json FROM (SELECT {_RECORD} FROM tx_records) r"),
        "parse_json": _tx(f"SELECT {_RECORD} FROM tx_records"),
        "parse_json_irregular": _irregular(damaged=False),
        "damaged_records": _irregular(damaged=True),
        "flatten_payload": _tx(f"SELECT {_RECORD} FROM tx_records"),
        "to_json_records": _tx(f"SELECT {_RECORD}, event_time, transaction_value FROM tx"),
        "event_time": _tx('SELECT transaction_id, "timestamp", event_time FROM tx'),
        "event_time_literal_pattern": _tx(
            'SELECT transaction_id, "timestamp", CAST(NULL AS TIMESTAMP) AS event_time FROM tx_records'
        ),
        "transaction_value": _tx("SELECT transaction_id, price, quantity, transaction_value FROM tx"),
        "raw_transactions": _tx(f"SELECT {_RECORD}, event_time, transaction_value FROM tx"),
        "latest_by_key": _tx("""
            SELECT user_id, transaction_id, event_time, transaction_status, transaction_value
            FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                    ORDER BY event_time DESC, transaction_id DESC) AS place FROM tx)
            WHERE place = 1"""),
        "rejected_rows": f"""WITH {_TX.strip()},{_batches(86_400, "tx")}
SELECT batch_id, 'null key: category' AS reason, count(*) AS order_count,
       {_half_up(_money("transaction_value"))} AS category_revenue,
       {_half_up(_money("transaction_value") + " / count(transaction_value)")} AS avg_order_value
FROM batches WHERE category IS NULL GROUP BY batch_id""",
        "clustered_geo": f"""WITH {_TX.strip()},{_batches(365 * 86_400, "tx")}
SELECT batch_id, country, city, {_GEO.strip()}
FROM batches GROUP BY batch_id, country, city""",
        "batch_lookup": _replay(f"""
            SELECT batch_id, make_timestamp(batch_id * 86400000000) AS batch_time, category, {_CATEGORY.strip()}
            FROM batches WHERE batch_id = 19737 GROUP BY batch_id, category"""),
        "transaction_metrics": _tx(f"SELECT {_STATS.strip()} FROM tx"),
        "success_rate": _tx(f"""
            SELECT count(*) AS total_transactions, count(*) FILTER (WHERE ok) AS successful_transactions,
                   {_rate("count(*) FILTER (WHERE ok)", "count(*)")} AS success_rate_percentage
            FROM tx"""),
        "user_metrics": _tx(f"SELECT {_USERS.strip()} FROM tx"),
        "category_metrics": _tx(f"SELECT category, {_CATEGORY.strip()} FROM tx GROUP BY category"),
        "payment_metrics": _tx(f"SELECT payment_method, {_PAYMENT.strip()} FROM tx GROUP BY payment_method"),
        "geo_metrics": _tx(f"SELECT country, city, {_GEO.strip()} FROM tx GROUP BY country, city"),
        "failed_transactions": _tx(f"SELECT {_FAILED} FROM tx WHERE failed"),
        "high_value_alerts": _tx(f"SELECT {_ALERTS} FROM tx WHERE transaction_value > 1000"),
        "unknown_status": _tx("""
            SELECT transaction_id, transaction_status, transaction_value FROM tx
            WHERE transaction_status IS NULL OR transaction_status = ''"""),
        "log_counts": _tx("""
            SELECT count(*) FILTER (WHERE failed) AS failed_logged,
                   count(*) FILTER (WHERE transaction_value > 1000) AS high_value_alerts
            FROM tx"""),
        "status_breakdown": _tx(
            'SELECT transaction_status, count(*) AS "count" FROM tx GROUP BY transaction_status'
        ),
        "sample_records": _tx("""
            SELECT transaction_id, transaction_status, transaction_value FROM tx
            ORDER BY transaction_id LIMIT 5"""),
        "distinct_statuses": _tx("SELECT DISTINCT transaction_status FROM tx"),
        "batch_summary": _tx(f"""
            SELECT total_transactions, successful_transactions, failed_transactions, pending_transactions,
                   unknown_status, success_rate_percentage, total_revenue, avg_transaction_value
            FROM (SELECT {_STATS.strip()} FROM tx)"""),
        "zero_success_batches": _replay(
            f"""
            SELECT batch_id, total_transactions, successful_transactions, failed_transactions,
                   pending_transactions, unknown_status, success_rate_percentage, total_revenue,
                   avg_transaction_value
            FROM (SELECT batch_id, {_STATS.strip()} FROM batches GROUP BY batch_id)
            WHERE success_rate_percentage = 0""",
            10,
        ),
        "zero_success_statuses": _replay(
            f"""
            SELECT batch_id, transaction_status, count(*) AS "count" FROM batches WHERE batch_id IN (
              SELECT batch_id FROM (SELECT batch_id, {_STATS.strip()} FROM batches GROUP BY batch_id)
              WHERE success_rate_percentage = 0)
            GROUP BY batch_id, transaction_status""",
            10,
        ),
        "status_tally": _tx(f"""
            SELECT *, {_rate("success_count", "total_sent", 1)} AS success_percent,
                   {_rate("failed_count", "total_sent", 1)} AS failed_percent,
                   {_rate("pending_count", "total_sent", 1)} AS pending_percent
            FROM (SELECT count(*) AS total_sent,
                         count(*) FILTER (WHERE ok) AS success_count,
                         count(*) FILTER (WHERE failed) AS failed_count,
                         count(*) FILTER (WHERE NOT coalesce(ok OR failed, FALSE)) AS pending_count
                  FROM tx)"""),
        "domain_violations": _counted(_DOMAINS, "violations"),
        "missing_fields": _counted(_MISSING, "missing"),
        "interval_transaction_metrics": _interval(_STATS),
        "interval_transaction_metrics_10s": _interval(_STATS, width_seconds=10),
        "interval_user_metrics": _interval(_USERS),
        "interval_category_metrics": _interval(_CATEGORY, "category"),
        "interval_payment_metrics": _interval(_PAYMENT, "payment_method"),
        "interval_geo_metrics": _interval(_GEO, "country, city"),
        "interval_failed": _replay(f"SELECT batch_id, {_FAILED} FROM batches WHERE failed"),
        "interval_alerts": _replay(f"SELECT batch_id, {_ALERTS} FROM batches WHERE transaction_value > 1000"),
        "daily_aggregates": f"""WITH {_TX.strip()},
days AS (
  SELECT {_DAY} AS "date", count(*) AS total_transactions,
         {_half_up(_money("settled"))} AS total_revenue,
         {_half_up(_money("transaction_value") + " / count(transaction_value)")} AS avg_transaction_value,
         count(DISTINCT user_id) AS unique_customers,
         count(*) FILTER (WHERE ok) AS successful_transactions,
         count(*) FILTER (WHERE failed) AS failed_transactions,
         {_rate("count(*) FILTER (WHERE ok)", "count(*)")} AS success_rate
  FROM tx GROUP BY 1
),
categories AS ({_top("category", "transaction_value", "top_category")}
),
countries AS ({_top("country", "settled", "top_country")}
)
SELECT days.*, top_category, top_country
FROM days JOIN categories USING ("date") JOIN countries USING ("date")""",
        "daily_top_category": _tx(_top("category", "transaction_value", "top_category")),
        "daily_top_country": _tx(_top("country", "settled", "top_country")),
        "dashboard_metrics": f"WITH {_TX.strip()},\nm AS (SELECT {_STATS.strip()} FROM tx)\n{_dashboard()}",
        "dashboard_latest": f"""WITH {_EVENTS.strip()},{_batches(86_400)},
m AS (
  SELECT make_timestamp(batch_id * 86400000000) AS batch_time, {_STATS.strip()}
  FROM batches WHERE batch_id = (SELECT max(batch_id) FROM batches) GROUP BY batch_id
)
{_dashboard(", batch_time AS last_updated")}""",
        "user_metrics_error": _tx("SELECT count(DISTINCT user_id) AS unique_users, TRUE AS within_error FROM tx"),
        "category_metrics_error": _tx("""
            SELECT category, count(DISTINCT product_id) AS unique_products,
                   count(DISTINCT user_id) AS unique_customers, TRUE AS within_error FROM tx GROUP BY category"""),
        "geo_metrics_error": _tx("""
            SELECT country, city, count(DISTINCT user_id) AS unique_customers, TRUE AS within_error
            FROM tx GROUP BY country, city"""),
        "daily_aggregates_error": _tx(f"""
            SELECT {_DAY} AS "date", count(DISTINCT user_id) AS unique_customers, TRUE AS within_error
            FROM tx GROUP BY 1"""),
        "daily_unique_error": f"""WITH {_EVENTS.strip()}
SELECT {_DAY} AS "date", count(DISTINCT user_id) AS unique_customers, TRUE AS within_error
FROM event_tx GROUP BY 1""",
        "rejected_tables": _rejected_tables(),
        "rejects_replayed": _rejects_replayed(),
        "current_rows": _tx(f"""
            SELECT year AS batch_id, {_RECORD.replace('"transaction_id"', "user_id AS transaction_id")}
            FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY year DESC,
                    {", ".join(f'"{name}" DESC NULLS LAST' for name in RECORD_FIELDS if name != "transaction_id")}) AS place
                  FROM (SELECT *, CAST(year(event_time) AS BIGINT) AS year FROM tx))
            WHERE place = 1"""),
        "compacted_batches": _interval(_PAYMENT, "payment_method", 3600),
        "offset_gaps": _offset_gaps(),
        "stream_late_file": f"{_STREAM}\nSELECT count(*) AS transactions FROM stream",
        "stream_repeats": f"""{_STREAM}
SELECT transaction_id, event_time, transaction_value FROM stream""",
        "stream_ingest": f"""{_STREAM}
SELECT {_RECORD}, event_time, transaction_value, TRUE AS is_stamped, batch_id FROM stream""",
        "stream_transaction_metrics": _stream(_STATS),
        "stream_user_metrics": _stream(_USERS),
        "stream_category_metrics": _stream(_CATEGORY, "category"),
        "stream_payment_metrics": _stream(_PAYMENT, "payment_method"),
        "stream_geo_metrics": _stream(_GEO, "country, city"),
        "stream_failed": f"{_STREAM}\nSELECT batch_id, {_FAILED} FROM stream WHERE failed",
        "stream_alerts": f"{_STREAM}\nSELECT batch_id, {_ALERTS} FROM stream WHERE transaction_value > 1000",
        "stream_restart": f"""{_STREAM}
SELECT count(DISTINCT batch_id) AS batches, count(*) AS transactions FROM stream""",
        "stream_empty_batch": f"{_STREAM}\nSELECT batch_id, count(*) AS total_transactions FROM stream GROUP BY batch_id",
    }
