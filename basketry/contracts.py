"""Names and types of every table, layer by layer.

A raw table has the same columns as its bronze table, all of them strings. The
column names, file names and types below are fixed values: files and tables
written by others must line up with them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

_TYPES = {
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
}


def struct(columns: str) -> StructType:
    """A schema from ``name type, ...``; unlike ``fromDDL`` it needs no running session."""
    out = StructType()
    for column in columns.split(", "):
        name, kind = column.split()
        out.add(name, _TYPES[kind])
    return out


SNAPSHOT_COLUMN = "ingestion_date"

# Columns that say where a row came from; they follow the data columns.
BRONZE_LINEAGE = "source_file_name string, raw_ingestion_date string, bronze_processed_at timestamp"

ITEM_COLUMNS = "order_id int, product_id int, add_to_cart_order int, reordered int"

PRODUCT_COLUMNS = (
    "product_id int, product_name string, aisle_id int, aisle string, "
    "department_id int, department string"
)

ENRICHED_ITEM_COLUMNS = (
    f"{ITEM_COLUMNS}, user_id int, eval_set string, order_number int, order_dow int, "
    "order_hour_of_day int, days_since_prior_order double, is_first_order boolean, "
    "product_name string, aisle_id int, aisle string, department_id int, department string, "
    "bronze_raw_ingestion_date string, silver_processed_at timestamp"
)


@dataclass(frozen=True)
class Entity:
    """One of the six source files and the types its columns get in bronze."""

    name: str
    file_name: str
    ddl: str

    @property
    def schema(self) -> StructType:
        return struct(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            "orders",
            "orders.csv",
            "order_id int, user_id int, eval_set string, order_number int, order_dow int, "
            "order_hour_of_day int, days_since_prior_order double",
        ),
        Entity(
            "products",
            "products.csv",
            "product_id int, product_name string, aisle_id int, department_id int",
        ),
        Entity("departments", "departments.csv", "department_id int, department string"),
        Entity("aisles", "aisles.csv", "aisle_id int, aisle string"),
        Entity("order_products_prior", "order_products__prior.csv", ITEM_COLUMNS),
        Entity("order_products_train", "order_products__train.csv", ITEM_COLUMNS),
    )
}

SILVER: dict[str, str] = {
    "orders_clean": (
        "order_id int, user_id int, eval_set string, order_number int, order_dow int, "
        "order_hour_of_day int, days_since_prior_order double, bronze_raw_ingestion_date string, "
        "is_first_order boolean, silver_processed_at timestamp"
    ),
    "products_enriched": (
        f"{PRODUCT_COLUMNS}, bronze_raw_ingestion_date string, silver_processed_at timestamp"
    ),
    "order_items_prior_enriched": ENRICHED_ITEM_COLUMNS,
    "order_items_train_enriched": ENRICHED_ITEM_COLUMNS,
}

GOLD: dict[str, str] = {
    "orders_by_period": (
        "order_dow int, order_hour_of_day int, total_orders bigint, distinct_users bigint, "
        "avg_orders_per_user double, gold_processed_at timestamp"
    ),
    "top_products": (
        f"{PRODUCT_COLUMNS}, total_order_rows bigint, distinct_orders bigint, "
        "distinct_users bigint, total_reorders bigint, reorder_rate double, "
        "gold_processed_at timestamp"
    ),
    "repurchase_metrics": (
        f"{PRODUCT_COLUMNS}, total_order_rows bigint, total_reorders bigint, "
        "distinct_users bigint, distinct_reordering_users bigint, distinct_orders bigint, "
        "distinct_reorder_orders bigint, reorder_rate double, gold_processed_at timestamp"
    ),
}

LAYERS: dict[str, dict[str, StructType]] = {
    "bronze": {
        e.name: struct(f"{e.ddl}, {BRONZE_LINEAGE}") for e in ENTITIES.values()
    },
    "silver": {name: struct(ddl) for name, ddl in SILVER.items()},
    "gold": {name: struct(ddl) for name, ddl in GOLD.items()},
}
LAYERS["raw"] = {
    e.name: struct(", ".join(f"{c} string" for c in e.columns))
    for e in ENTITIES.values()
}

PRODUCT_KEYS = struct(PRODUCT_COLUMNS).fieldNames()
AUDIT_COLUMNS = (
    "source_file_name",
    "bronze_processed_at",
    "silver_processed_at",
    "gold_processed_at",
)


def contract(layer: str, table: str) -> StructType:
    return LAYERS[layer][table]
