"""Business questions about departments, aisles, baskets and returning customers.

All take silver tables. Every group is reduced by a combining aggregate before
its shuffle, and none is ever held whole by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.columns import all_present, ratio4
from basketry.functions.ranks import weight_before
from basketry.operators.gold import purchase_measures

# Upper ends of the order-count groups of customers; the last group is open.
FREQUENCY_GROUPS = [(1, "1"), (5, "2-5"), (10, "6-10"), (20, "11-20")]
TOP_FREQUENCY_GROUP = "21+"

# Upper ends, inclusive, of the days before the second order, and first days of the time since the
# first; both last classes are open.
COHORTS = [(30, "0-30"), (90, "31-90"), (365, "91-365")]
LAST_COHORT, NO_COHORT = "366+", "unknown"
PERIODS = [(720, "720+"), (360, "360-719"), (180, "180-359"), (90, "90-179"), (0, "0-89")]
#: Orders of a customer that one task puts in order; their sums are put in order after that.
_CHUNK = 256


def _with_share(counted: DataFrame, total: Column, amount: str, share: str) -> DataFrame:
    return counted.withColumn(share, ratio4(F.col(amount), total))


def item_share(items: DataFrame, keys: list[str]) -> DataFrame:
    """Items bought per group and their share of all items."""
    counted = items.groupBy(*keys).agg(F.count(F.lit(1)).alias("item_count"))
    total = counted.agg(F.sum("item_count")).scalar()
    return _with_share(counted, total, "item_count", "item_share")


def department_volume(items: DataFrame) -> DataFrame:
    return item_share(items, ["department_id", "department"])


def aisle_share(items: DataFrame) -> DataFrame:
    return item_share(items, ["aisle_id", "aisle"])


def basket_size(items: DataFrame) -> DataFrame:
    """Orders, items and mean items per order, in one row."""
    per_order = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("item_count"))
    return per_order.agg(
        F.count(F.lit(1)).alias("order_count"),
        F.coalesce(F.sum("item_count"), F.lit(0)).alias("item_count"),
    ).withColumn("avg_items_per_order", ratio4(F.col("item_count"), F.col("order_count")))


def order_interval(orders: DataFrame) -> DataFrame:
    """Mean days between the orders of each customer.

    First orders hold a made-up zero and are left out; a customer with no later
    order has a NULL mean.
    """
    days = F.when(~F.col("is_first_order"), F.col("days_since_prior_order"))
    return (
        orders.groupBy("user_id")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum(days).alias("days"),
            F.count(days).alias("intervals"),
        )
        .select(
            "user_id",
            "order_count",
            ratio4(F.col("days"), F.col("intervals")).alias("avg_days_between_orders"),
        )
    )


def successive_products(items: DataFrame) -> DataFrame:
    """Per product: how often a customer bought it in an order and again in the next.

    The order numbers of a customer and product become bits, 63 numbers to a word,
    and the first number of a word is also the last bit of the word before. Two
    neighbouring bits are then one repeat, counted in one word only. Setting bits
    combines before the shuffle, so rows shrink to about one per customer and
    product, where a sorted window would move every purchase and hold all those of
    a customer in one task.
    """
    number = F.col("order_number").cast("bigint")
    bit = F.pmod(number, F.lit(63))
    word = F.floor((number - bit) / 63)
    here = F.struct(word.alias("word"), F.expr("shiftleft(1L, CAST(bit AS INT))").alias("mark"))
    before = F.struct((word - 1).alias("word"), F.expr("shiftleft(1L, 63)").alias("mark"))
    marks = F.when(bit == 0, F.array(here, before)).otherwise(F.array(here))
    product = ["product_id", "product_name"]
    per_user = (
        items.withColumn("bit", bit)
        .select(*product, "user_id", F.inline(marks))
        .groupBy(*product, "user_id", "word")
        .agg(F.bit_or("mark").alias("marks"))
        .withColumn("repeats", F.expr("bit_count(marks & shiftrightunsigned(marks, 1))"))
        .where(F.col("repeats") > 0)
        .groupBy(*product, "user_id")
        .agg(F.sum("repeats").alias("repeats"))
    )
    return per_user.groupBy(*product).agg(
        F.sum("repeats").alias("successive_purchases"),
        F.count(F.lit(1)).alias("distinct_users"),
    )


def department_repurchase(items: DataFrame) -> DataFrame:
    """Repurchase measures per department and the share of its customers who came back."""
    measures = purchase_measures(items, ["department_id", "department"])
    return measures.withColumn(
        "returning_user_share",
        ratio4(F.col("distinct_reordering_users"), F.col("distinct_users")),
    )


def user_frequency(orders: DataFrame) -> DataFrame:
    """Customers and orders per order-count group, with mean days between orders."""
    days = F.when(~F.col("is_first_order"), F.col("days_since_prior_order"))
    per_user = orders.groupBy("user_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum(days).alias("days"),
        F.count(days).alias("intervals"),
    )
    group = F.lit(TOP_FREQUENCY_GROUP)
    for upper, name in reversed(FREQUENCY_GROUPS):
        group = F.when(F.col("order_count") <= upper, name).otherwise(group)
    return (
        per_user.groupBy(group.alias("frequency_group"))
        .agg(
            F.count(F.lit(1)).alias("user_count"),
            F.sum("order_count").alias("order_count"),
            F.sum("days").alias("days"),
            F.sum("intervals").alias("intervals"),
        )
        .select(
            "frequency_group",
            "user_count",
            "order_count",
            ratio4(F.col("days"), F.col("intervals")).alias("avg_days_between_orders"),
        )
    )


def _cohort(second: Column) -> Column:
    """The cohort of a customer whose second order came after so many days."""
    cohort = F.when(second.isNull(), NO_COHORT)
    for upper, name in COHORTS:
        cohort = cohort.when(second <= upper, name)
    return cohort.otherwise(LAST_COHORT)


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Customers who order again, by cohort and time since their first order.

    A cohort is how many days a customer took for the second order; ``unknown`` without one. The
    period is the sum of days between orders since the first that is there, unknown days as none. The
    share is that of the cohort's customers, all of whom are in the first period. A customer's orders
    are summed up in chunks of their numbers, so that none fills a task.
    """
    chunk = F.floor((F.col("order_number") - 1) / _CHUNK)
    numbered = orders.select(
        "user_id", chunk.alias("chunk"), "order_number", F.col("days_since_prior_order").alias("days")
    )
    # All columns are used below and no join adds a filter to these, so that both uses of the rows
    # share one scan and shuffle.
    numbered = numbered.where(all_present(["user_id", "chunk"])).repartition("user_id", "chunk")
    sums = numbered.groupBy("user_id", "chunk").agg(
        F.coalesce(F.sum("days"), F.lit(0.0)).alias("sum"),
        F.min(F.when(F.col("order_number") == 2, F.col("days"))).alias("second"),
        F.coalesce(F.min_by(F.coalesce("days", F.lit(0.0)), "order_number"), F.lit(0.0)).alias("first"),
    )
    user = Window.partitionBy("user_id")
    by_chunk = user.orderBy("chunk")
    before = sums.select(
        "user_id",
        "chunk",
        (F.sum("sum").over(by_chunk) - F.col("sum") - F.first("first").over(by_chunk)).alias("before"),
        F.min("second").over(user).alias("second"),
    )
    inside = Window.partitionBy("user_id", "chunk").orderBy("order_number")
    running = F.coalesce(F.sum("days").over(inside), F.lit(0.0))
    placed = numbered.withColumn("running", running).join(before, ["user_id", "chunk"])
    since, second = F.col("before") + F.col("running"), F.col("second")
    period = F.lit(None)
    for lower, name in reversed(PERIODS):
        period = F.when(since >= lower, name).otherwise(period)
    counted = (
        placed.groupBy(_cohort(second).alias("cohort"), period.alias("period"), "user_id")
        .agg(F.count(F.lit(1)).alias("orders"))
        .groupBy("cohort", "period")
        .agg(F.count(F.lit(1)).alias("user_count"), F.sum("orders").alias("order_count"))
    )
    first_period = F.when(F.col("period") == PERIODS[-1][1], F.col("user_count"))
    whole = F.max(first_period).over(Window.partitionBy("cohort"))
    return _with_share(counted, whole, "user_count", "user_share")


def basket_evolution(items: DataFrame) -> DataFrame:
    """Mean items per order and share of items bought again, per order number."""
    per_order = items.groupBy("order_number", "order_id").agg(
        F.count(F.lit(1)).alias("items"), F.sum("reordered").alias("reorders")
    )
    return (
        per_order.groupBy("order_number")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("items").alias("item_count"),
            F.sum("reorders").alias("total_reorders"),
        )
        .withColumn("avg_items_per_order", ratio4(F.col("item_count"), F.col("order_count")))
        .withColumn("reorder_rate", ratio4(F.col("total_reorders"), F.col("item_count")))
    )


def basket_similarity(items: DataFrame) -> DataFrame:
    """How much of a basket a customer's next basket keeps: mean Jaccard similarity by order number.

    The similarity of two baskets is the number of products in both over the number in either. A product that a
    customer bought in orders n and n + 1 is found by a join of the purchases with themselves, shifted by one
    order, so no customer's baskets are ever held by one task. An order counts if the order before it has items. Of a
    customer's orders with one number all products count as one basket.
    """
    known = items.where(all_present(["user_id", "order_number", "product_id"]))
    bought = known.select("user_id", "order_number", "product_id").distinct()
    before = bought.select("user_id", (F.col("order_number") + 1).alias("order_number"), "product_id")
    kept = before.join(bought, ["user_id", "order_number", "product_id"])
    basket = ["user_id", "order_number"]
    size = bought.groupBy(*basket).agg(F.count(F.lit(1)).alias("size"))
    former = size.select("user_id", (F.col("order_number") + 1).alias("order_number"), F.col("size").alias("former"))
    common = kept.groupBy(*basket).agg(F.count(F.lit(1)).alias("common"))
    pairs = size.join(former, basket).join(common, basket, "left")
    both = F.coalesce("common", F.lit(0))
    # In millionths, rounded, so that the sum is the same in any order of adding.
    similarity = F.round(both / (F.col("size") + F.col("former") - both) * 1_000_000).cast("bigint")
    return (
        pairs.groupBy("order_number")
        .agg(
            F.count(F.lit(1)).alias("basket_count"),
            F.sum(both).alias("kept_products"),
            F.count_if(both == 0).alias("all_new"),
            F.sum(similarity).alias("millionths"),
        )
        .withColumn("mean_similarity", ratio4(F.col("millionths"), F.col("basket_count") * 1_000_000))
        .drop("millionths")
    )


def order_survival(orders: DataFrame) -> DataFrame:
    """Per cohort and order number k: the customers who got to k, and the estimated share who ever do.

    Cohorts are those of ``cohort_retention``. A customer whose last known order is k left after it, unless that order is in
    the test set: then the data end there and nobody knows, the customer is censored at k. ``reached`` customers have
    an order k or later, ``at_risk`` of them are known to have ordered again or left, and the product over
    all numbers before k of the share of these who went on is the estimate (Kaplan and Meier's product
    limit); ``share`` takes censored customers for ones who left. What is ordered are a histogram's rows, one for
    each cohort and number, never customers.
    """
    by_user = orders.groupBy("user_id").agg(
        F.max(F.struct("order_number", (F.col("eval_set") == "test").alias("censored"))).alias("last"),
        F.min(F.when(F.col("order_number") == 2, F.col("days_since_prior_order"))).alias("second"),
    )
    ended = by_user.groupBy(
        _cohort(F.col("second")).alias("cohort"), F.col("last.order_number").alias("order_number")
    ).agg(F.count(F.lit(1)).alias("ended"), F.count_if("last.censored").alias("censored"))
    later = Window.partitionBy("cohort").orderBy(F.desc("order_number"))
    earlier = Window.partitionBy("cohort").orderBy("order_number").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("cohort")
    counted = ended.withColumn("reached", F.sum("ended").over(later))
    at_risk, gone = F.col("reached") - F.col("censored"), F.col("ended") - F.col("censored")
    # With nobody at risk nobody is known to go. Where all go, later numbers have estimate 0.
    went_on = F.when(gone == 0, F.lit(1.0)).otherwise((at_risk - gone) / F.nullif(at_risk, F.lit(0)))
    logs = F.sum(F.when(went_on > 0, F.ln(went_on))).over(earlier)
    none = F.coalesce(F.max(went_on == 0).over(earlier), F.lit(False))
    estimate = F.when(none, 0.0).otherwise(F.exp(F.coalesce(logs, F.lit(0.0))))
    return counted.select(
        "cohort", "order_number", "reached", at_risk.alias("at_risk"), "ended", "censored",
        ratio4(F.col("reached"), F.max("reached").over(whole)).alias("share"),
        F.round(estimate, 4).alias("estimate"),
    )


def frequency_ranks(orders: DataFrame, groups: int = 10) -> DataFrame:
    """Customers in ``groups`` of equal size by their number of orders, the least active first.

    The exact rank of a customer is the number of customers with fewer orders, so that customers with as many orders
    have one rank and one group. It comes from a histogram with a row for each number of orders that occurs, see
    ``weight_before``. Group g has the ranks from (g - 1) / groups to g / groups of all customers; one that ties
    span is missing.
    """
    per_user = orders.groupBy("user_id").agg(F.count("order_id").alias("orders"))
    histogram = per_user.groupBy("orders").agg(F.count(F.lit(1)).alias("users"))
    whole = histogram.agg(F.sum("users")).scalar()
    rank = F.floor(F.col("before") * groups / whole) + 1
    return (
        weight_before(histogram, "orders", "users")
        .groupBy(rank.alias("frequency_rank"))
        .agg(
            F.sum("users").alias("user_count"),
            F.min("orders").alias("fewest_orders"),
            F.max("orders").alias("most_orders"),
            F.sum(F.col("users") * F.col("orders")).alias("order_count"),
        )
    )
