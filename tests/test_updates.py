"""Gold kept up to date from a state, and purchases at several levels."""

from __future__ import annotations

import random

import pytest
from samples import ENRICHED

from basketry.contracts import PRODUCT_KEYS
from basketry.operators import gold
from basketry.plans import medallion
from basketry.sources.snapshots import read_snapshot, write_snapshot


def some_items(seed: int, orders: range) -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for order in orders:
        user = draw.choice([1, 2, 3, 32767, 32768, 70_000, -5])
        for product in draw.choices(range(12), k=draw.randint(1, 9)):
            aisle = None if product == 5 else product // 3
            row = (
                order, product, draw.choice([0, 1, 1, None]), user, order, draw.choice(["a", None, "b"]),
                aisle, None if aisle is None else f"aisle {aisle}", product // 6, None if product > 9 else "d",
            )
            rows.append(row)
    return rows


def told(df) -> list[str]:
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("place_by_user", [False, True])
def test_merged_states_equal_one_run(make, place_by_user):
    parts = [some_items(i, range(100 * i, 100 * i + 40)) for i in range(3)]
    states = [gold.purchase_state(make(ENRICHED, *p), PRODUCT_KEYS, place_by_user) for p in parts]
    merged = gold.merge_states([gold.merge_states(states[:2], PRODUCT_KEYS), states[2]], PRODUCT_KEYS)
    whole = make(ENRICHED, *[row for p in parts for row in p])
    assert told(gold.measures_of(merged, PRODUCT_KEYS)) == told(gold.product_measures(whole))


@pytest.fixture
def roots(tmp_path):
    return medallion.Roots.under(str(tmp_path))


def test_an_update_reads_only_newer_items(spark, roots):
    from basketry.contracts import contract

    kind = contract("silver", "order_items_prior_enriched")
    known = dict(zip(ENRICHED.split(", "), range(99), strict=False))
    names = [c.split()[0] for c in known]

    def land(label, rows):
        table = spark.createDataFrame([tuple(dict(zip(names, r, strict=True)).get(f.name) for f in kind) for r in rows], kind)
        write_snapshot(table, roots.table("silver", "order_items_prior_enriched"), label)

    first, second, third = (some_items(i, range(50 * i, 50 * i + 30)) for i in range(3))
    land("2026-01-01", first)
    assert [s.label for s in medallion.update_product_rankings(spark, roots)] == ["2026-01-01"] * 2
    assert medallion.update_product_rankings(spark, roots) == []
    land("2026-01-02", second)
    land("2026-01-03", third)
    # What went into the state is not read again, so that the first items may be gone.
    write_snapshot(
        read_snapshot(spark, roots.table("silver", "order_items_prior_enriched"), "2026-01-01").limit(0),
        roots.table("silver", "order_items_prior_enriched"), "2026-01-01",
    )
    assert [s.label for s in medallion.update_product_rankings(spark, roots)] == ["2026-01-03"] * 2
    whole = gold.product_measures(spark.createDataFrame(first + second + third, ENRICHED))
    for table in ("top_products", "repurchase_metrics"):
        got = read_snapshot(spark, roots.table("gold", table), "2026-01-03").drop("gold_processed_at")
        assert told(got) == told(gold.product_ranking(whole, table).drop("gold_processed_at"))


def test_levels_equal_distinct_counts(make):
    rows = some_items(7, range(200))
    got = {tuple(r)[:7]: tuple(r)[7:11] for r in gold.purchase_rollup(make(ENRICHED, *rows)).collect()}
    want: dict[tuple, list] = {}
    for r in rows:
        keys = [r[8], r[9], r[6], r[7], r[1], r[5]]
        for level in range(4):
            known = keys[: 2 * level] + [None] * (6 - 2 * level)
            want.setdefault((level, *known), []).append(r)
    assert got.keys() == want.keys()
    for key, own in want.items():
        flags = [r[2] for r in own if r[2] is not None]
        again = {r[3] for r in own if r[2] == 1}
        assert got[key] == (len(own), sum(flags) if flags else None, len({r[3] for r in own}), len(again))


def test_levels_shuffle_the_items_once(spark, make):
    df = gold.purchase_rollup(make(ENRICHED, *some_items(7, range(50))))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    places = [line for line in plan.splitlines() if "Exchange hashpartitioning(place" in line and "Reused" not in line]
    assert len(places) == 1 and "REPARTITION" in places[0]
    assert "Expand" not in plan


def test_levels_of_no_items(make):
    assert gold.purchase_rollup(make(ENRICHED)).collect() == []


def test_states_merged_by_key_equal_one_run(make):
    parts = [some_items(i, range(100 * i, 100 * i + 40)) for i in range(3)]
    states = [gold.purchase_state(make(ENRICHED, *p), PRODUCT_KEYS, place_by_key=True) for p in parts]
    merged = gold.merge_states(states, PRODUCT_KEYS, place_by_key=True)
    whole = make(ENRICHED, *[row for p in parts for row in p])
    assert told(gold.measures_of(merged, PRODUCT_KEYS)) == told(gold.product_measures(whole))
