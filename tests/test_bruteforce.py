"""The metrics against plain Python over random, dirty and skewed rows."""

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest

from tillwright.operators import keyed, metrics
from tillwright.schema import RECORD_DDL, RECORD_FIELDS
from tillwright.sources.decode import derive


def random_records(seed, n=400):
    rng = random.Random(seed)
    for i in range(n):
        hot = rng.random() < 0.4  # one category, user and city hold much of the rows
        yield {
            "transaction_id": f"t{i % (n - 20)}",
            "user_id": "u0" if hot else rng.choice([None, "u1", "u2", "u3", "u4"]),
            "gender": rng.choice(["Male", "Female", "Other", "male", None]),
            "age": rng.choice([None, 18, 30, 70]),
            "country": "C0" if hot else rng.choice([None, "C1", "C2"]),
            "city": "c0" if hot else rng.choice([None, "c1", "c2"]),
            "product_id": rng.choice([None, "p1", "p2", "p3"]),
            "category": "k0" if hot else rng.choice([None, "k1", "k2"]),
            "quantity": rng.choice([None, 1, 2, 3]),
            "price": rng.choice([None, round(rng.uniform(0.01, 900), 2)]),
            "payment_method": rng.choice([None, "UPI", "COD"]),
            "transaction_status": rng.choice(["Success", "Failed", "Pending", "", None, "success"]),
            "timestamp": "2024-01-01 00:00:00",
        }


def value(r):
    return None if r["price"] is None or r["quantity"] is None else Decimal(repr(r["price"])) * r["quantity"]


def cents(number):
    return None if number is None else float(Decimal(number).quantize(Decimal("0.01"), ROUND_HALF_UP))


def total(values):
    values = [v for v in values if v is not None]
    return sum(values) if values else None


def mean(values):
    values = [v for v in values if v is not None]
    return Decimal(sum(values)) / len(values) if values else None


def settled(rows):
    return total([value(r) if r["transaction_status"] == "Success" else Decimal(0) for r in rows])


def share(part, whole):
    return cents(Decimal(part) / whole * 100)


def distinct(rows, name):
    return len({r[name] for r in rows} - {None})


def count(rows, name, wanted):
    return sum(r[name] == wanted for r in rows)


def wanted(rows, table):
    values = [value(r) for r in rows]
    known = [v for v in values if v is not None]
    failed = count(rows, "transaction_status", "Failed")
    if table == "transaction":
        return {
            "total_transactions": len(rows),
            "successful_transactions": count(rows, "transaction_status", "Success"),
            "failed_transactions": failed,
            "pending_transactions": count(rows, "transaction_status", "Pending"),
            "unknown_status": sum(not r["transaction_status"] for r in rows),
            "total_revenue": cents(settled(rows)),
            "avg_transaction_value": cents(mean(values)),
            "max_transaction_value": cents(max(known)) if known else None,
            "min_transaction_value": cents(min(known)) if known else None,
            "success_rate_percentage": share(count(rows, "transaction_status", "Success"), len(rows)),
        }
    if table == "user":
        users = distinct(rows, "user_id")
        spend = total(values)
        return {
            "unique_users": users,
            "avg_customer_age": cents(mean([r["age"] for r in rows])),
            "male_customers": count(rows, "gender", "Male"),
            "female_customers": count(rows, "gender", "Female"),
            "other_gender_customers": count(rows, "gender", "Other"),
            "avg_spend_per_user": cents(spend / users) if users and spend is not None else None,
        }
    if table == "category":
        return {
            "order_count": len(rows),
            "category_revenue": cents(total(values)),
            "avg_order_value": cents(mean(values)),
            "unique_products": distinct(rows, "product_id"),
            "unique_customers": distinct(rows, "user_id"),
        }
    if table == "payment":
        return {
            "transaction_count": len(rows),
            "successful_revenue": cents(settled(rows)),
            "failed_count": failed,
            "avg_transaction_value": cents(mean(values)),
            "success_rate": share(len(rows) - failed, len(rows)),
        }
    return {
        "transaction_count": len(rows),
        "revenue": cents(settled(rows)),
        "unique_customers": distinct(rows, "user_id"),
        "avg_transaction_value": cents(mean(values)),
    }


@pytest.mark.parametrize("seed", range(3))
def test_metrics(spark, seed):
    rows = list(random_records(seed))
    blank = dict.fromkeys(RECORD_FIELDS)
    tx = derive(spark.createDataFrame([tuple({**blank, **r}.values()) for r in rows], RECORD_DDL))
    tables = {
        "transaction": (metrics.transaction_metrics(tx), []),
        "user": (metrics.user_metrics(tx, distinct="exact"), []),
        "category": (metrics.category_metrics(tx, distinct="exact"), ["category"]),
        "payment": (metrics.payment_metrics(tx), ["payment_method"]),
        "geo": (metrics.geo_metrics(tx, distinct="exact"), ["country", "city"]),
        # The same with an extra key, as in a replay.
        "user by gender": (metrics.user_metrics(tx, ["gender"], "exact"), ["gender"]),
        "payment by category": (metrics.payment_metrics(tx, ["category"]), ["category", "payment_method"]),
    }
    for name, (frame, keys) in tables.items():
        groups = defaultdict(list)
        for r in rows:
            groups[tuple(r[k] for k in keys)].append(r)
        got = {tuple(r[k] for k in keys): r.asDict() for r in frame.collect()}
        want = {
            key: {**dict(zip(keys, key)), **wanted(members, name.split()[0])} for key, members in groups.items()
        }
        assert got == want, name


@pytest.mark.parametrize("seed", range(2))
def test_latest(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.randint(0, 5), i) for i in range(300)]
    frame = spark.createDataFrame(rows, "k string, v int, i int").repartition(5)
    got = {tuple(r) for r in keyed.latest_by_key(frame, ["k"], ["v", "i"]).collect()}
    best = {}
    for k, v, i in rows:
        if k not in best or (v, i) > best[k][1:]:
            best[k] = (k, v, i)
    assert got == set(best.values())
