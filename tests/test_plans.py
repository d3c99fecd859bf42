"""The shape of the plans: what is pushed down, what is shuffled, what is split."""

import re

import pytest
from pyspark.sql import functions as F
from samples import ENRICHED, item

from basketry.contracts import contract
from basketry.functions.skew import UNEVEN, hot_keys, uneven_share
from basketry.operators import gold, silver
from basketry.plans import driver_tables, stored
from basketry.sources.snapshots import read_snapshot, write_snapshot

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def items(spark):
    return stored.silver_table(spark, SF, "order_items_prior_enriched")


def test_distinct_counts_do_not_multiply_rows(spark, items):
    orders = stored.silver_table(spark, SF, "orders_clean")
    for df in (
        gold.top_products(items),
        gold.repurchase_metrics(items, place_by_user=True),
        gold.orders_by_period(orders),
    ):
        assert "Expand" not in plan(df)


def test_placing_by_order_sorts_once_and_gives_the_same_rows(spark):
    orders = stored.bronze_table(spark, SF, "orders")
    placed = silver.orders_clean(orders, place_by_order=True).drop("silver_processed_at")
    assert len(re.findall(r"\bSort \[", plan(placed))) == 1
    assert len(re.findall(r"Exchange", plan(placed))) == 1
    combined = silver.orders_clean(orders).drop("silver_processed_at")
    assert sorted(map(str, placed.collect())) == sorted(map(str, combined.collect()))


def test_placing_by_user_moves_items_once(items):
    exchanges = re.findall(r"Exchange (\w+)", plan(gold.top_products(items, place_by_user=True)))
    # Items once, one row per task and product, and the sort.
    assert exchanges == ["rangepartitioning", "hashpartitioning", "hashpartitioning"]
    assert "REPARTITION_BY_COL" in plan(gold.top_products(items, place_by_user=True))


def test_gold_reads_only_its_columns(items):
    read = re.search(r"ReadSchema: struct<(.*)", plan(gold.top_products(items)))[1]
    assert "days_since" not in read
    assert "eval_set" not in read


def test_order_filters_reach_the_scan(spark):
    df = silver.orders_clean(stored.bronze_table(spark, SF, "orders"))
    scan = df._jdf.queryExecution().optimizedPlan().toString()
    pushed = re.search(r"PushedFilters: \[(.*)", plan(df))[1]
    assert "IsNotNull(order_id)" in pushed
    assert scan.count("Filter") == 1


def test_no_python_in_any_layer(spark, items):
    for df in (
        silver.orders_clean(stored.bronze_table(spark, SF, "orders")),
        gold.repurchase_metrics(items),
    ):
        assert "Python" not in plan(df)


def test_test_tables_need_no_window_but_to_number_orders(spark):
    for name, table in driver_tables.RAW_TABLES.items():
        assert ("Window" in plan(table(spark, SF))) == (name == "orders")


def test_hot_keys(spark):
    df = spark.range(0, 100000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 50 == 1, 8)
        .otherwise(F.col("id") + 100)
        .cast("int")
        .alias("a"),
        F.col("id").cast("int").alias("b"),
        F.when(F.col("id") % 2 == 0, 5).cast("int").alias("c"),
    )
    assert hot_keys(df, "a", "b", "c") == {"a": [7, 8], "b": [], "c": [5]}
    assert hot_keys(df, "a", share=0.1) == {"a": [7]}
    assert hot_keys(df.where("false"), "a") == {"a": []}


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.mark.parametrize("hot", ["order_id", "product_id"])
def test_hot_order_or_product_is_split_among_tasks(spark, tmp_path, hot):
    n = 60000
    other = {"order_id": "product_id", "product_id": "order_id"}[hot]
    ids = spark.range(0, n, 1, 8)
    bronze_items = ids.select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 900).cast("int").alias(hot),
        (F.col("id") % 700).cast("int").alias(other),
        F.lit(1).alias("add_to_cart_order"),
        F.lit(1).alias("reordered"),
        F.lit("d").alias("raw_ingestion_date"),
    )
    orders = spark.range(1000).select(
        F.col("id").cast("int").alias("order_id"),
        F.lit(5).alias("user_id"),
        F.lit("prior").alias("eval_set"),
        F.lit(2).alias("order_number"),
        F.lit(1).alias("order_dow"),
        F.lit(1).alias("order_hour_of_day"),
        F.lit(1.0).alias("days_since_prior_order"),
        F.lit("d").alias("bronze_raw_ingestion_date"),
        F.lit(False).alias("is_first_order"),
        F.current_timestamp().alias("silver_processed_at"),
    )
    products = spark.range(1000).select(
        F.col("id").cast("int").alias("product_id"),
        F.lit("n").alias("product_name"),
        F.lit(1).alias("aisle_id"),
        F.lit("a").alias("aisle"),
        F.lit(1).alias("department_id"),
        F.lit("d").alias("department"),
        F.lit("d").alias("bronze_raw_ingestion_date"),
        F.current_timestamp().alias("silver_processed_at"),
    )
    before = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    tables = {}
    for name, df in (("items", bronze_items), ("orders", orders), ("products", products)):
        write_snapshot(df, f"{tmp_path}/{name}", "d")
        tables[name] = read_snapshot(spark, f"{tmp_path}/{name}")
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        df = silver.order_items_enriched(tables["items"], tables["orders"], tables["products"])
        rows = df.collect()
        assert "skew=true" in plan(df)
        assert len(rows) == n
        assert sum(getattr(r, hot) == 1 for r in rows) >= n / 3
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_customer_and_copies_give_the_same_measures(make):
    rows = [item(o, 1, 1, user_id=5) for o in range(300)] * 2 + [item(7, 1, 1, user_id=5)] * 400
    rows += [item(1000 + o, o % 4, o % 2, user_id=o % 9) for o in range(500)]
    items = make(ENRICHED, *rows)
    natural = {tuple(r) for r in gold.product_measures(items).collect()}
    placed = {tuple(r) for r in gold.product_measures(items, place_by_user=True).collect()}
    assert natural == placed
    assert hot_keys(items, "user_id", share=0.3)["user_id"] == [5]


@pytest.mark.parametrize("partitions", [16, 64])
def test_a_customer_just_below_the_share_fills_no_task(spark, make, partitions):
    """The share follows the shuffle partitions, so no task gets many times the mean."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        share, n = uneven_share(spark), 64_000
        assert share == UNEVEN / partitions
        own = F.col("id") < int(n * share * 0.8)  # one customer, all of one product
        items = spark.range(n).select(
            F.when(own, 1).otherwise(F.col("id") % 5000 + 2).cast("int").alias("user_id"),
            F.when(own, 1).otherwise(F.col("id") % 900).cast("int").alias("product_id"),
        )
        assert hot_keys(items, "user_id", share=share) == {"user_id": []}
        placed = items.repartition("product_id", "user_id")
        largest = placed.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert largest <= (UNEVEN + 2) * n / partitions
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_stored_tables_follow_the_contract(spark, items):
    assert items.columns == contract("silver", "order_items_prior_enriched").fieldNames()
