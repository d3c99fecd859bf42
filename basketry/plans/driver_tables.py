"""The six raw tables, derived from the star-schema tables of the test data.

Everything is text, as if read from CSV, with dirt placed by key arithmetic: ids
in blanks, junk, decimals, values out of range, copies, empty rows, unknown
products and missing dimension rows. Each table is one scan without a shuffle, but
for the two small dimensions, which are distinct values of `part`, and for the numbers
of a customer's orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.contracts import ENTITIES
from basketry.functions.shuffles import freed_at_end
from basketry.sources.raw import DEFAULT, Dialect

# Department ids by product type. STANDARD has an id but no department row.
DEPARTMENT_IDS = {
    "ECONOMY": 1,
    "LARGE": 2,
    "MEDIUM": 3,
    "PROMO": 4,
    "SMALL": 5,
    "STANDARD": 6,
}
NO_DEPARTMENT = "STANDARD"
NO_AISLE = "Brand#13"


# The columns used, declared so that opening a table needs no job to read its footer.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_returnflag string, "
        "l_linestatus string"
    ),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(value: Column) -> Column:
    return value.cast("string")


def _numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their number 1..n within the customer and the days since the one before.

    Numbers are made of the orders on earlier days, counted for each customer and day, and of the
    place within the day, so that no task gets all orders of a customer.
    """
    orders = _table(spark, sf_dir, "orders")
    day = ["o_custkey", "o_orderdate"]
    earlier = Window.partitionBy("o_custkey").orderBy("o_orderdate")
    days = orders.groupBy(*day).agg(F.count(F.lit(1)).alias("n"))
    days = days.select(
        *day,
        (F.sum("n").over(earlier) - F.col("n")).alias("before"),
        F.date_diff("o_orderdate", F.lag("o_orderdate").over(earlier)).alias("gap"),
    )
    place = F.row_number().over(Window.partitionBy(*day).orderBy("o_orderkey"))
    return orders.withColumn("place", place).join(days, day).select(
        *orders.columns,
        (F.col("before") + F.col("place")).alias("number"),
        F.when(F.col("place") > 1, 0).otherwise(F.col("gap")).alias("days"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    number = _text(F.col("number"))

    def every(n: int) -> Column:
        return key % n == 0

    columns = {
        "order_id": F.concat(F.lit(" "), _text(key), F.lit(" ")),
        "user_id": F.when(every(89), "n/a").otherwise(_text(F.col("o_custkey"))),
        "eval_set": F.when(every(11), "test").when(every(5), "train").otherwise(" PRIOR "),
        "order_number": F.when(every(79), F.concat(number, F.lit(".9"))).otherwise(number),
        "order_dow": F.when(every(97), "7")
        .when(every(113), "1e2")
        .otherwise(_text(F.dayofweek("o_orderdate") - 1)),
        "order_hour_of_day": F.when(every(101), "10.0")
        .when(every(109), ".5")
        .otherwise(_text(key % 24)),
        "days_since_prior_order": F.when(every(13), F.lit(None))
        .when(every(107), "abc")
        .otherwise(F.concat(_text(F.col("days")), F.lit(".0"))),
    }
    order = F.struct(*(c.alias(n) for n, c in columns.items()))
    empty = F.struct(*(F.lit(None).cast("string").alias(n) for n in columns))
    # Each order once; some twice; some followed by a row of NULLs.
    rows = F.concat(
        F.array_repeat(order, F.when(every(103), 2).otherwise(1)),
        F.array_repeat(empty, F.when(every(499), 1).otherwise(0)),
    )
    return _numbered_orders(spark, sf_dir).select(F.inline(rows))


def _department_id() -> Column:
    ids = F.create_map(*(F.lit(x) for pair in DEPARTMENT_IDS.items() for x in pair))
    return _text(ids[F.col("p_type")])


def _aisle_id() -> Column:
    return F.regexp_extract("p_brand", "([0-9]+)", 1)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    every_17 = F.col("p_partkey") % 17 == 0
    name = F.concat("p_name", F.when(every_17, ', "large"').otherwise(""), F.lit(" "))
    return _products(spark, sf_dir, name)


def _products(spark: SparkSession, sf_dir: str, name: Column) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.concat(F.lit(" "), _text(F.col("p_partkey"))).alias("product_id"),
        name.alias("product_name"),
        _aisle_id().alias("aisle_id"),
        _department_id().alias("department_id"),
    )


def raw_aisles(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = _table(spark, sf_dir, "part").select("p_brand").distinct()
    return brands.where(F.col("p_brand") != NO_AISLE).select(
        _aisle_id().alias("aisle_id"), F.col("p_brand").alias("aisle")
    )


def raw_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = _table(spark, sf_dir, "part").select("p_type").distinct()
    return types.where(F.col("p_type") != NO_DEPARTMENT).select(
        _department_id().alias("department_id"), F.lower("p_type").alias("department")
    )


def _raw_items(spark: SparkSession, sf_dir: str, again: Column) -> DataFrame:
    part = F.col("l_partkey")
    return _table(spark, sf_dir, "lineitem").select(
        _text(F.col("l_orderkey")).alias("order_id"),
        _text(F.when(part % 131 == 0, part + 1_000_000).otherwise(part)).alias("product_id"),
        _text(F.col("l_linenumber")).alias("add_to_cart_order"),
        F.when(part % 61 == 0, F.lit(None)).when(again, "1").otherwise("0").alias("reordered"),
    )


def raw_order_products_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_items(spark, sf_dir, F.col("l_returnflag") == "R")


def raw_order_products_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_items(spark, sf_dir, F.col("l_linestatus") == "F")


def raw_products_in_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products, every third one with a name of several lines, quotes and commas."""
    lines = F.concat(F.replace("p_name", F.lit(" "), F.lit("\n")), F.lit('\n\n"'), "p_type", F.lit('",\n'), "p_name")
    other = F.concat("p_name", F.lit(' 5" x'))
    return _products(spark, sf_dir, F.when(F.col("p_partkey") % 3 == 0, lines).otherwise(other))


RAW_TABLES = {
    "orders": raw_orders,
    "products": raw_products,
    "departments": raw_departments,
    "aisles": raw_aisles,
    "order_products_prior": raw_order_products_prior,
    "order_products_train": raw_order_products_train,
}


def write_csv(table: DataFrame, path: str, dialect: Dialect = DEFAULT) -> None:
    """A CSV source, blanks kept: a directory of parts with a header each."""
    out = (
        table.write.option("header", True)
        .option("escape", dialect.escape)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    with freed_at_end(table.sparkSession):
        out.csv(path)


def write_source_files(spark: SparkSession, sf_dir: str, folder: str, *entities: str) -> None:
    """Write raw tables as CSV sources."""
    for name in entities or RAW_TABLES:
        write_csv(RAW_TABLES[name](spark, sf_dir), f"{folder}/{ENTITIES[name].file_name}")


def damaged(table: DataFrame, contract: StructType) -> DataFrame:
    """The table without its first column, with one too many, the second of another type."""
    first, second = contract.fieldNames()[:2]
    other = "int" if contract[second].dataType.simpleString() == "bigint" else "bigint"
    broken = F.length(F.col(second).cast("string")).cast(other)
    return table.drop(first).withColumn(second, broken).withColumn("surplus", F.lit("x"))
