"""Gold: the order calendar and the two product rankings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.contracts import PRODUCT_KEYS, contract
from basketry.functions.columns import processed_at, ratio4


def orders_by_period(orders: DataFrame, batch_time: datetime | None = None) -> DataFrame:
    """Orders and customers per weekday and hour, sorted by both.

    ``orders`` has one row per order (``orders_clean`` sees to that), so orders
    are counted, not de-duplicated again. That leaves one distinct count, which
    Spark plans without copying rows.
    """
    period = ["order_dow", "order_hour_of_day"]
    return (
        orders.groupBy(*period)
        .agg(
            F.count("order_id").alias("total_orders"),
            F.count_distinct("user_id").alias("distinct_users"),
        )
        .select(
            *period,
            "total_orders",
            "distinct_users",
            ratio4(F.col("total_orders"), F.col("distinct_users")).alias("avg_orders_per_user"),
            processed_at(batch_time).alias("gold_processed_at"),
        )
        .orderBy(*period)
    )


def purchase_measures(
    items: DataFrame, keys: list[str], place_by_user: bool = False, place_by_key: bool = False
) -> DataFrame:
    """Rows, reorders and the exact distinct customers and orders per ``keys``.

    Four distinct counts in one aggregate would multiply the rows by five before
    the shuffle. Instead rows are reduced to (keys, customer, order), then to
    (keys, customer), then to keys. This needs each order to have one customer,
    which the join to ``orders_clean`` gives.

    By default each step combines, shuffles and combines again, which is safe for
    any data but moves about all rows twice. With ``place_by_user`` rows move once,
    placed by first key and customer, and the first two steps run where they lie.
    Use it when no customer holds more rows than a few tasks do on average, that is when
    ``hot_keys(items, "user_id", share=uneven_share(spark))`` names none; a customer's rows of one
    product then are no more than that either.

    With ``place_by_key`` rows are placed by the first key alone, and every step runs where they lie, so that nothing else
    moves. It goes before ``place_by_user`` and is for first keys of which ``hot_keys`` names none; see ``skew.placing``.
    """
    return measures_of(purchase_state(items, keys, place_by_user, place_by_key), keys)


def _placed(df: DataFrame, *by: str) -> DataFrame:
    # Given their number, parts are not put together again: several steps hold a row for each order of theirs.
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def purchase_state(
    items: DataFrame, keys: list[str], place_by_user: bool = False, place_by_key: bool = False
) -> DataFrame:
    """What ``purchase_measures`` needs to know of each of ``keys`` and customer.

    States of disjoint orders can be merged, see ``merge_states``.
    """
    if place_by_key:
        items = _placed(items, keys[0])
    elif place_by_user:
        items = _placed(items, keys[0], "user_id")
    again = F.col("reordered") == 1
    per_order = items.groupBy(*keys, "user_id", "order_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("reordered").alias("reorders"),
        F.max(F.when(again, 1)).alias("again"),
    )
    return per_order.groupBy(*keys, "user_id").agg(
        F.sum("rows").alias("rows"),
        F.sum("reorders").alias("reorders"),
        F.count("order_id").alias("orders"),
        F.count(F.when(F.col("again") == 1, F.col("order_id"))).alias("reorder_orders"),
        F.max("again").alias("again"),
    )


def merge_states(states: list[DataFrame], keys: list[str], place_by_key: bool = False) -> DataFrame:
    """One state of several, none of which has an order of another.

    With ``place_by_key`` rows are placed by the first key before they are merged, and lie so afterwards.
    """
    every = states[0]
    for state in states[1:]:
        every = every.unionByName(state)
    if place_by_key:
        every = _placed(every, keys[0])
    return every.groupBy(*keys, "user_id").agg(
        *[F.sum(c).alias(c) for c in ("rows", "reorders", "orders", "reorder_orders")],
        F.max("again").alias("again"),
    )


def measures_of(state: DataFrame, keys: list[str]) -> DataFrame:
    """The measures of each of ``keys`` from its state."""
    return (
        state.groupBy(*keys)
        .agg(
            F.sum("rows").alias("total_order_rows"),
            F.sum("reorders").alias("total_reorders"),
            F.count("user_id").alias("distinct_users"),
            F.count(F.when(F.col("again") == 1, F.col("user_id"))).alias(
                "distinct_reordering_users"
            ),
            F.sum("orders").alias("distinct_orders"),
            F.sum("reorder_orders").alias("distinct_reorder_orders"),
        )
        .withColumn("reorder_rate", ratio4(F.col("total_reorders"), F.col("total_order_rows")))
    )


def product_measures(items: DataFrame, place_by_user: bool = False, place_by_key: bool = False) -> DataFrame:
    """The measures that both product rankings select from.

    Products are told apart by all six of their columns: one id under two names
    gives two rows.
    """
    return purchase_measures(items, PRODUCT_KEYS, place_by_user, place_by_key)


# Sort columns of each ranking, largest first. Ties are in no particular order.
_RANKED_BY = {
    "top_products": ("total_order_rows", "distinct_orders"),
    "repurchase_metrics": ("reorder_rate", "total_reorders"),
}


def product_ranking(
    measures: DataFrame, table: str, batch_time: datetime | None = None
) -> DataFrame:
    """One of the two rankings from ``product_measures``, which both can share."""
    return (
        measures.withColumn("gold_processed_at", processed_at(batch_time))
        .select(*contract("gold", table).fieldNames())
        .orderBy(*(F.desc(c) for c in _RANKED_BY[table]))
    )


def top_products(
    items: DataFrame,
    batch_time: datetime | None = None,
    place_by_user: bool = False,
    place_by_key: bool = False,
) -> DataFrame:
    """Every product, the one bought most first."""
    return product_ranking(product_measures(items, place_by_user, place_by_key), "top_products", batch_time)


def repurchase_metrics(
    items: DataFrame,
    batch_time: datetime | None = None,
    place_by_user: bool = False,
    place_by_key: bool = False,
) -> DataFrame:
    """Every product, the one most often bought again first."""
    return product_ranking(product_measures(items, place_by_user, place_by_key), "repurchase_metrics", batch_time)


_LEVELS = [["department_id", "department"], ["aisle_id", "aisle"], ["product_id", "product_name"]]


def purchase_rollup(items: DataFrame) -> DataFrame:
    """Purchases of everything (level 0), each department (1), aisle (2) and product (3).

    Columns of lower levels are NULL. Customers are counted exactly at every level after a single shuffle of the items,
    which places 32,768 neighbouring customer ids together. Products are counted from one row for each product and
    customer. Above them the customers of an aisle are the bits of a bitmap, one for each aisle and place; those of
    a department and of everything are such bitmaps put together where they lie. Only counts leave the place, so
    what moves in the end are a few numbers for each group and place. A customer who alone fills a task weighs as much
    here; ``hot_keys`` finds such ones.
    """
    keys = [c for level in _LEVELS for c in level]
    place = F.expr("bitmap_bucket_number(user_id)")
    placed = items.select(*keys, "user_id", "reordered", place.alias("place")).repartition("place")
    sums = [F.sum(c).alias(c) for c in ("rows", "reorders")]
    per_user = placed.groupBy("place", *keys, "user_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("reordered").alias("reorders"),
        F.max(F.when(F.col("reordered") == 1, F.expr("bitmap_bit_position(user_id)"))).alias("again"),
    )
    bits = F.expr("bitmap_construct_agg(bitmap_bit_position(user_id))")
    again = F.expr("bitmap_construct_agg(again)")
    by_aisle = per_user.groupBy("place", *_LEVELS[0], *_LEVELS[1]).agg(
        *sums, bits.alias("users"), again.alias("reordering_users")
    )
    merged = [F.expr(f"bitmap_or_agg({c})").alias(c) for c in ("users", "reordering_users")]
    by_department = by_aisle.groupBy("place", *_LEVELS[0]).agg(*sums, *merged)
    over_all = by_department.groupBy("place").agg(*sums, *merged)
    counted = [F.expr(f"bitmap_count({c})").alias(c) for c in ("users", "reordering_users")]
    products = per_user.groupBy("place", *keys).agg(
        *sums, F.count(F.lit(1)).alias("users"), F.count("again").alias("reordering_users")
    )
    levels = []
    for level, table in enumerate([over_all, by_department, by_aisle, products]):
        known = [c for part in _LEVELS[:level] for c in part]
        numbers = ["users", "reordering_users"] if level == len(_LEVELS) else counted
        columns = [F.col(c) if c in known else F.lit(None).cast(items.schema[c].dataType).alias(c) for c in keys]
        levels.append(table.select(F.lit(level).alias("level"), *columns, "rows", "reorders", *numbers))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return (
        every.groupBy("level", *keys)
        .agg(
            F.sum("rows").alias("total_order_rows"),
            F.sum("reorders").alias("total_reorders"),
            F.sum("users").alias("distinct_users"),
            F.sum("reordering_users").alias("distinct_reordering_users"),
        )
        .withColumn("reorder_rate", ratio4(F.col("total_reorders"), F.col("total_order_rows")))
    )
