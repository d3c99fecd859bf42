"""Silver: valid orders, products with their names, and items joined to both."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.contracts import ITEM_COLUMNS, PRODUCT_KEYS, contract, struct
from basketry.functions.columns import all_present, processed_at
from basketry.sources.buckets import Bucketed

_REQUIRED = [
    "order_id", "user_id", "order_number", "order_dow", "order_hour_of_day", "eval_set",
]


def orders_clean(
    orders: DataFrame, batch_time: datetime | None = None, place_by_order: bool = False
) -> DataFrame:
    """One valid row per order.

    Weekday must be 0..6 and hour 0..23. A customer's first order counts as zero
    days since the one before. Of several rows for one order the smallest is
    kept, so a re-run keeps the same one.

    By default ``min`` over a struct combines copies before the shuffle, so an
    order repeated millions of times costs no more; for that rows are sorted
    before and after it. With ``place_by_order`` they are shuffled as they are and
    sorted once, which is a little faster where it is known that no order has
    many rows; searching for such orders costs more than the sort.
    """
    first = F.coalesce(F.col("order_number") == 1, F.lit(False))
    valid = (
        orders.where(all_present(_REQUIRED))
        .where(F.col("order_dow").between(0, 6) & F.col("order_hour_of_day").between(0, 23))
        .select(
            "order_id",
            "user_id",
            F.lower(F.trim("eval_set")).alias("eval_set"),
            "order_number",
            "order_dow",
            "order_hour_of_day",
            F.when(first, 0.0).otherwise(F.col("days_since_prior_order")).alias(
                "days_since_prior_order"
            ),
            F.col("raw_ingestion_date").alias("bronze_raw_ingestion_date"),
            first.alias("is_first_order"),
        )
    )
    rest = [c for c in valid.columns if c != "order_id"]
    if place_by_order:
        valid = valid.repartition("order_id")
    return (
        valid.groupBy("order_id")
        .agg(F.min(F.struct(*rest)).alias("kept"))
        .select("order_id", "kept.*", processed_at(batch_time).alias("silver_processed_at"))
    )


def products_enriched(
    products: DataFrame,
    aisles: DataFrame,
    departments: DataFrame,
    batch_time: datetime | None = None,
) -> DataFrame:
    """Products with aisle and department names.

    Nothing is filtered or de-duplicated: an id listed twice in a dimension gives
    two product rows. No broadcast is forced; Spark does it when the measured
    size of a dimension allows.
    """
    return (
        products.join(aisles.select("aisle_id", "aisle"), "aisle_id", "left")
        .join(departments.select("department_id", "department"), "department_id", "left")
        .select(
            *PRODUCT_KEYS,
            F.col("raw_ingestion_date").alias("bronze_raw_ingestion_date"),
            processed_at(batch_time).alias("silver_processed_at"),
        )
    )


def order_items_enriched(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    batch_time: datetime | None = None,
) -> DataFrame:
    """Order items (prior or train) with the columns of their order and product.

    Items of rejected orders disappear; items of unknown products stay, with NULL
    product columns. Items meet orders first, while their rows are narrow, and
    product names are added last. Given stored tables, both joins shuffle both
    sides just for the join (or broadcast a side found small), which is what lets
    adaptive execution split the rows of a hot order or product among tasks.
    """
    item_columns = struct(ITEM_COLUMNS).fieldNames()
    return (
        items.where(all_present(["order_id", "product_id"]))
        .select(*item_columns, F.col("raw_ingestion_date").alias("bronze_raw_ingestion_date"))
        .join(orders.drop("bronze_raw_ingestion_date", "silver_processed_at"), "order_id")
        .join(products.select(*PRODUCT_KEYS), "product_id", "left")
        .withColumn("silver_processed_at", processed_at(batch_time))
        .select(*contract("silver", "order_items_prior_enriched").fieldNames())
    )


def order_items_from_buckets(
    items: Bucketed, orders: Bucketed, products: DataFrame, batch_time: datetime | None = None
) -> DataFrame:
    """``order_items_enriched`` of items and orders that are stored in equal buckets of order_id.

    Neither is shuffled to meet the other. Items of hot orders, which no bucket holds, get their order from a
    broadcast: there are at most as many as ``hot_keys`` can name, with one row each.
    """
    if items.key != "order_id" or (items.key, items.count) != (orders.key, orders.count):
        raise ValueError("items and orders need the same number of buckets of order_id")
    joined = order_items_enriched(items.buckets, orders.buckets, products, batch_time)
    if not items.hot:
        return joined
    few = F.broadcast(orders.all().where(F.col("order_id").isin(items.hot)))
    return joined.unionByName(order_items_enriched(items.apart, few, products, batch_time))
