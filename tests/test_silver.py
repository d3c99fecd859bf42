import pytest
from samples import AISLES, DEPARTMENTS, ITEMS, ORDERS, PRODUCTS, RAW_DATE, order

from basketry.contracts import contract
from basketry.operators import silver


def clean(make, *rows):
    return {r.order_id: r for r in silver.orders_clean(make(ORDERS, *rows)).collect()}


def same_columns(df, table):
    expected = contract("silver", table)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in expected]


def test_orders_columns(make, batch_time):
    df = silver.orders_clean(make(ORDERS, order(1)), batch_time)
    same_columns(df, "orders_clean")
    row = df.first()
    assert row.silver_processed_at == batch_time
    assert row.bronze_raw_ingestion_date == RAW_DATE


def test_ranges_are_inclusive(make):
    dows = {i: d for i, d in enumerate([-1, 0, 6, 7, None])}
    kept = clean(make, *(order(i, dow=d) for i, d in dows.items()))
    assert set(kept) == {1, 2}
    hours = {i: h for i, h in enumerate([-1, 0, 23, 24, None])}
    kept = clean(make, *(order(i, hour=h) for i, h in hours.items()))
    assert set(kept) == {1, 2}


def test_required_columns(make):
    rows = [order(None), order(2, user_id=None), order(3, eval_set=None), order(4, number=None)]
    assert clean(make, *rows) == {}


def test_first_order(make):
    kept = clean(
        make,
        order(1, number=1, days=9.0),
        order(2, number=1, days=None),
        order(3, number=4, days=None),
        order(4, number=4, days=5.0),
        order(5, number=0, days=5.0),
        order(6, number=-3, days=5.0),
    )
    got = {i: (r.is_first_order, r.days_since_prior_order) for i, r in kept.items()}
    assert got == {
        1: (True, 0.0),
        2: (True, 0.0),
        3: (False, None),
        4: (False, 5.0),
        5: (False, 5.0),
        6: (False, 5.0),
    }


def test_eval_set_is_lowered_and_trimmed_but_not_checked(make):
    rows = [order(1, eval_set=" PRIOR "), order(2, eval_set="Other"), order(3, eval_set="")]
    kept = clean(make, *rows)
    assert {i: r.eval_set for i, r in kept.items()} == {1: "prior", 2: "other", 3: ""}


def test_one_row_per_order_and_always_the_same(spark, make):
    rows = [order(1, user_id=u, hour=h) for u in (9, 3, 5) for h in (7, 2)] * 3
    once = clean(make, *rows)
    again = clean(make, *reversed(rows))
    assert list(once) == [1]
    assert (once[1].user_id, once[1].order_hour_of_day) == (3, 2)
    assert once[1].asDict() | {"silver_processed_at": 0} == again[1].asDict() | {
        "silver_processed_at": 0
    }


def test_invalid_copy_does_not_hide_a_valid_one(make):
    assert clean(make, order(1, user_id=1, dow=9), order(1, user_id=2))[1].user_id == 2


def enriched(make, products, aisles, departments):
    return silver.products_enriched(
        make(PRODUCTS, *products), make(AISLES, *aisles), make(DEPARTMENTS, *departments)
    )


def test_products(make):
    df = enriched(
        make,
        [(1, "x", 1, 1, RAW_DATE), (2, "y", 9, 1, RAW_DATE), (None, "z", None, None, RAW_DATE)],
        [(1, "a1"), (1, "a2"), (None, "never")],
        [(1, "d1")],
    )
    same_columns(df, "products_enriched")
    got = sorted(
        ((r.product_id, r.aisle_id, r.aisle, r.department) for r in df.collect()), key=str
    )
    # Aisle 1 is listed twice; product 2 has an unknown aisle; a NULL id stays and matches nothing.
    assert got == [(1, 1, "a1", "d1"), (1, 1, "a2", "d1"), (2, 9, None, "d1"), (None,) * 4]


@pytest.fixture
def items(make):
    orders = [order(1, user_id=4), order(2, dow=7), order(3, eval_set="train")]
    orders = silver.orders_clean(make(ORDERS, *orders))
    products = enriched(
        make, [(7, "a", 1, 1, RAW_DATE), (7, "b", 1, 1, RAW_DATE), (8, "c", 1, 1, RAW_DATE)],
        [(1, "aisle")], [(1, "dep")],
    )
    rows = [
        (1, 7, 1, 1, "2026-01-01"),
        (1, 8, 2, 0, "2026-01-01"),
        (1, 99, 3, None, "2026-01-01"),
        (1, None, 4, 1, "2026-01-01"),
        (None, 8, 5, 1, "2026-01-01"),
        (2, 8, 1, 1, "2026-01-01"),
        (3, 8, 1, 1, "2026-01-01"),
        (5, 8, 1, 1, "2026-01-01"),
    ]
    return silver.order_items_enriched(make(ITEMS, *rows), orders, products)


def test_items(items):
    same_columns(items, "order_items_prior_enriched")
    got = sorted(
        (
            (r.order_id, r.product_id, r.product_name, r.aisle_id, r.user_id)
            for r in items.collect()
        ),
        key=str,
    )
    assert got == [
        (1, 7, "a", 1, 4),
        (1, 7, "b", 1, 4),
        (1, 8, "c", 1, 4),
        (1, 99, None, None, 4),
        (3, 8, "c", 1, 1),
    ]


def test_items_are_labelled_by_their_own_snapshot(items):
    assert {r.bronze_raw_ingestion_date for r in items.collect()} == {"2026-01-01"}
