from __future__ import annotations

import threading
import time

import pytest

from basketry.contracts import contract
from basketry.functions.shuffles import freed_at_end
from basketry.functions.together import together
from basketry.plans import driver_tables, lineage, medallion
from basketry.sources.snapshots import read_snapshot, write_snapshot

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LABEL = "2026-04-01"


def shuffle_files(spark) -> set[str]:
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "/shuffle_" in f}


def left(spark, before: set[str]) -> set[str]:
    """Files of shuffles that were not there before, once Spark had time to delete them."""
    until = time.time() + 10
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


def counted(spark):
    return spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count()


@pytest.fixture
def with_items(spark, tmp_path):
    """Tables with a snapshot of the items: product 1 bought by customers 1 and 2 (again), product 2 by customer 1."""
    rows = [
        (order, product, 1, again, user, "prior", 1, 0, 0, 1.0, False, f"p{product}", 1, "a", 2, "d", LABEL, None)
        for order, user, product, again in [(1, 1, 1, 0), (2, 2, 1, 0), (3, 2, 1, 1), (1, 1, 2, 0)]
    ]
    roots = medallion.Roots.under(str(tmp_path / "tables"))
    items = spark.createDataFrame(rows, contract("silver", "order_items_prior_enriched"))
    write_snapshot(items, roots.table("silver", "order_items_prior_enriched"), LABEL)
    return roots


def test_a_snapshot_leaves_no_shuffle_on_disk(spark, tmp_path):
    before = shuffle_files(spark)
    kept = counted(spark)  # held, so that no collection of garbage frees what it shuffled
    assert write_snapshot(kept, str(tmp_path / "a"), LABEL).rows == 10
    assert not left(spark, before)
    driver_tables.write_csv(kept.selectExpr("string(k)"), str(tmp_path / "b"))
    assert not left(spark, before)
    assert sorted(kept.collect()) == [(k, 100) for k in range(10)]  # and it can be run again


def test_the_setting_is_as_before_after_the_last_of_several_blocks(spark):
    was = spark.conf.get(SETTING)
    with freed_at_end(spark):
        with freed_at_end(spark):
            assert spark.conf.get(SETTING) == "true"
        assert spark.conf.get(SETTING) == "true"
    assert spark.conf.get(SETTING) == was
    with pytest.raises(ZeroDivisionError), freed_at_end(spark):
        1 / 0
    assert spark.conf.get(SETTING) == was


def test_rankings_leave_no_shuffle_on_disk_and_keep_their_order_and_rows(spark, with_items, batch_time):
    before = shuffle_files(spark)
    made = medallion.run_product_rankings(spark, with_items, batch_time)
    assert not left(spark, before)
    assert [s.root.rsplit("/", 1)[1] for s in made] == ["top_products", "repurchase_metrics"]
    top, again = (read_snapshot(spark, s.root, s.label) for s in made)
    assert [t.columns for t in (top, again)] == [
        contract("gold", t).fieldNames() for t in ("top_products", "repurchase_metrics")
    ]
    assert sorted(top.select("product_id", "total_order_rows", "distinct_orders", "distinct_users", "total_reorders",
                             "reorder_rate", "gold_processed_at").collect()) == [
        (1, 3, 3, 2, 1, 0.3333, batch_time), (2, 1, 1, 1, 0, 0.0, batch_time),
    ]
    assert sorted(again.select("product_id", "distinct_reordering_users", "distinct_reorder_orders").collect()) == [
        (1, 1, 1), (2, 0, 0),
    ]
    for name in ("top_products", "repurchase_metrics"):  # either alone, as if only it were stale
        (alone,) = medallion.run_product_rankings(spark, with_items, batch_time, (name,))
        assert alone.rows == 2
        assert lineage.recorded(spark, with_items, ("gold", name))
    items = with_items.table("silver", "order_items_prior_enriched")
    write_snapshot(read_snapshot(spark, items).where("false"), items, "2026-04-02")
    assert [s.rows for s in medallion.run_product_rankings(spark, with_items, batch_time)] == [0, 0]


def test_tables_of_items_are_built_one_after_the_other(spark, monkeypatch, tmp_path):
    running, most, order = [0], [0], []
    lock = threading.Lock()

    def build(name, result):
        def step(*args):
            with lock:
                if name == "items":
                    running[0] += 1
                    most[0] = max(most[0], running[0])
            time.sleep(0.3)
            with lock:
                running[0] -= name == "items"
                order.append(name)
            return result

        return step

    monkeypatch.setattr(medallion, "run_order_items", build("items", "items"))
    monkeypatch.setattr(medallion, "run_orders_by_period", build("period", "period"))
    monkeypatch.setattr(medallion, "run_product_rankings", build("rankings", ["top", "again"]))
    for name in ("run_bronze", "run_orders_clean", "run_products_enriched"):
        monkeypatch.setattr(medallion, name, build(name, name))
    roots = medallion.Roots.under(str(tmp_path))
    assert medallion.run_layer(spark, roots, "silver")[2:] == ["items", "items"]
    assert most == [1]
    monkeypatch.setattr(lineage, "stale_inputs", lambda *_: {t: {"any"} for t in lineage.TABLES})
    made = medallion.run_stale(spark, roots)
    assert most == [1]
    assert sorted(made) == sorted(
        ["run_bronze"] * 6 + ["run_orders_clean", "run_products_enriched", "items", "items", "period", "top", "again"]
    )


def test_steps_one_at_a_time_all_run_if_the_first_fails(spark):
    done = []
    with pytest.raises(ZeroDivisionError):
        together(spark, [lambda: 1 / 0, lambda: done.append(1)], at_once=1)
    assert done == [1]
