"""Small tables written out by hand."""

from __future__ import annotations

from basketry.contracts import ENTITIES

BRONZE_TAIL = ", raw_ingestion_date string"
ORDERS = ENTITIES["orders"].ddl + BRONZE_TAIL
PRODUCTS = ENTITIES["products"].ddl + BRONZE_TAIL
ITEMS = ENTITIES["order_products_prior"].ddl + BRONZE_TAIL
AISLES = ENTITIES["aisles"].ddl
DEPARTMENTS = ENTITIES["departments"].ddl
RAW_DATE = "2026-04-02"

ENRICHED = (
    "order_id int, product_id int, reordered int, user_id int, order_number int, "
    "product_name string, aisle_id int, aisle string, department_id int, department string"
)


def order(order_id, user_id=1, eval_set="prior", number=2, dow=0, hour=0, days=7.0):
    return (order_id, user_id, eval_set, number, dow, hour, days, RAW_DATE)


def item(order_id, product_id, reordered=0, user_id=1, number=1, name=None):
    name = name or f"p{product_id}"
    return (order_id, product_id, reordered, user_id, number, name, 1, "a", 2, "d")
