import random

import pytest
from pyspark.sql import functions as F
from samples import ENRICHED, ORDERS, item, order

from basketry.contracts import PRODUCT_KEYS, contract
from basketry.operators import gold, silver


def random_items(seed: int, rows: int = 600):
    rng = random.Random(seed)
    owner = {o: rng.choice([1, 2, 3, 4, None]) for o in range(60)}
    out = []
    for _ in range(rows):
        o, p = rng.randrange(60), rng.choice([1, 1, 1, 2, 3, 4])
        name = rng.choice(["x", "y", None]) if p == 3 else f"p{p}"
        out.append((o, p, rng.choice([0, 1, 1, None, 2]), owner[o], 1, name, None, "a", 2, None))
    return out


def plain(items):
    """The definition: exact distinct counts in one aggregate."""
    again = F.col("reordered") == 1
    return items.groupBy(*PRODUCT_KEYS).agg(
        F.count("*").alias("total_order_rows"),
        F.sum("reordered").alias("total_reorders"),
        F.count_distinct("user_id").alias("distinct_users"),
        F.count_distinct(F.when(again, F.col("user_id"))).alias("distinct_reordering_users"),
        F.count_distinct("order_id").alias("distinct_orders"),
        F.count_distinct(F.when(again, F.col("order_id"))).alias("distinct_reorder_orders"),
    )


def as_set(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("place_by_user", [False, True])
@pytest.mark.parametrize("seed", range(3))
def test_measures_equal_the_definition(make, seed, place_by_user):
    items = make(ENRICHED, *random_items(seed))
    got = gold.product_measures(items, place_by_user).drop("reorder_rate")
    assert as_set(got) == as_set(plain(items))


def test_all_null_reorders(make):
    items = make(ENRICHED, item(1, 1, None), item(2, 1, None), item(1, 2, 0), item(1, 3, 1))
    rows = gold.repurchase_metrics(items).collect()
    assert [(r.product_id, r.total_reorders, r.reorder_rate) for r in rows] == [
        (3, 1, 1.0),
        (2, 0, 0.0),
        (1, None, None),
    ]


def test_null_reordered_counts_in_the_denominator(make):
    items = make(ENRICHED, item(1, 1, 1), item(2, 1, None), item(3, 1, 0))
    assert gold.top_products(items).first().reorder_rate == 0.3333


def test_two_names_make_two_rows(make):
    items = make(ENRICHED, item(1, 7, name="a"), item(1, 7, name="b"))
    assert {(r.product_id, r.product_name) for r in gold.top_products(items).collect()} == {
        (7, "a"),
        (7, "b"),
    }


def test_rankings_are_sorted(make, batch_time):
    items = make(ENRICHED, *random_items(7))
    top = gold.top_products(items, batch_time)
    assert [(f.name, f.dataType) for f in top.schema] == [
        (f.name, f.dataType) for f in contract("gold", "top_products")
    ]
    keys = [(r.total_order_rows, r.distinct_orders) for r in top.collect()]
    assert keys == sorted(keys, reverse=True)
    again = gold.repurchase_metrics(items, batch_time)
    assert [(f.name, f.dataType) for f in again.schema] == [
        (f.name, f.dataType) for f in contract("gold", "repurchase_metrics")
    ]
    keys = [(r.reorder_rate, r.total_reorders) for r in again.collect()]
    assert keys == sorted(keys, reverse=True)


def test_invariants(make):
    items = make(ENRICHED, *random_items(11))
    top, again = gold.top_products(items).collect(), gold.repurchase_metrics(items).collect()
    shared = [c for c in top[0].asDict() if c != "gold_processed_at"]
    assert {tuple(r[c] for c in shared) for r in top} == {
        tuple(r[c] for c in shared) for r in again
    }
    assert sum(r.total_order_rows for r in top) == items.count()
    assert all(r.distinct_reorder_orders <= r.distinct_orders for r in again)
    assert all(r.distinct_reordering_users <= r.distinct_users for r in again)


def test_orders_by_period(make, batch_time):
    rng = random.Random(1)
    rows = [
        order(i, user_id=rng.randrange(9), dow=rng.randrange(7), hour=rng.randrange(24))
        for i in range(400)
    ]
    orders = silver.orders_clean(make(ORDERS, *rows, *rows[:50]))
    df = gold.orders_by_period(orders, batch_time)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in contract("gold", "orders_by_period")
    ]
    got = [
        (r.order_dow, r.order_hour_of_day, r.total_orders, r.distinct_users, r.avg_orders_per_user)
        for r in df.collect()
    ]
    groups = {}
    for r in rows:
        groups.setdefault((r[4], r[5]), []).append(r[1])
    want = [
        (*k, len(users), len(set(users)), round(len(users) / len(set(users)), 4))
        for k, users in sorted(groups.items())
    ]
    assert got == want


def test_placed_parts_are_not_put_together_again(spark):
    rows = "id % 50 AS product_id, id % 37 AS user_id, id AS order_id, 1 AS reordered"
    items = spark.range(2000).selectExpr(*rows.split(", "))
    state = gold.purchase_state(items, ["product_id"], place_by_user=True)
    parts = state.select(F.spark_partition_id().alias("part")).distinct().count()
    assert parts == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize("seed", range(3))
def test_placed_by_key_measures_equal_the_definition(make, seed):
    items = make(ENRICHED, *random_items(seed))
    got = gold.product_measures(items, place_by_key=True).drop("reorder_rate")
    assert as_set(got) == as_set(plain(items))


def test_placing_by_key_moves_rows_once(make):
    df = gold.product_measures(make(ENRICHED, *random_items(1)), place_by_key=True)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
