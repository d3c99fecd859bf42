from __future__ import annotations

import pytest
from test_raw import FILES

from basketry.contracts import ENTITIES, LAYERS
from basketry.plans import lineage, medallion
from basketry.sources import paths, raw
from basketry.sources.snapshots import read_snapshot, write_snapshot


@pytest.fixture
def landed(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    for name, text in FILES.items():
        (source / ENTITIES[name].file_name).write_text(text)
    roots = medallion.Roots.under(str(tmp_path / "tables"))
    raw.land_sources(spark, str(source), roots.raw, "2026-04-01")
    return roots


def names(summaries) -> set[str]:
    return {"/".join(s.root.rsplit("/", 2)[1:]) for s in summaries}


def land(spark, roots, tmp_path, entity, text, label):
    (tmp_path / "new.csv").write_text(text)
    write_snapshot(raw.read_lines(spark, str(tmp_path / "new.csv")), roots.table("raw", entity), label)


def test_every_table_has_its_inputs_before_it():
    built = [("raw", e) for e in ENTITIES]
    for table in lineage.TABLES:
        assert lineage.INPUTS[table] and set(lineage.INPUTS[table]) <= set(built)
        built.append(table)
    assert len(lineage.TABLES) == sum(len(LAYERS[x]) for x in ("bronze", "silver", "gold"))


def test_a_second_run_writes_nothing_and_a_landing_rebuilds_its_descendants(spark, landed, tmp_path):
    assert len(medallion.run_stale(spark, landed)) == len(lineage.TABLES)
    stored = {t: paths.data_files(spark, landed.table(*t)) for t in lineage.TABLES}
    assert medallion.run_stale(spark, landed) == []
    assert stored == {t: paths.data_files(spark, landed.table(*t)) for t in lineage.TABLES}

    land(spark, landed, tmp_path, "departments", "department_id,department\n1,new\n", "2026-04-03")
    made = medallion.run_stale(spark, landed)
    assert names(made) == {
        "bronze/departments", "silver/products_enriched", "silver/order_items_prior_enriched",
        "silver/order_items_train_enriched", "gold/top_products", "gold/repurchase_metrics",
    }
    assert {s.label for s in made if "departments" not in s.root} == {"2026-04-01"}
    top = read_snapshot(spark, landed.table("gold", "top_products")).collect()
    assert {r.department for r in top} == {"new", None}
    assert lineage.mixed_labels(spark, landed, ("silver", "products_enriched")) == ["2026-04-01", "2026-04-03"]
    assert lineage.mixed_labels(spark, landed, ("gold", "top_products")) == []
    assert medallion.run_stale(spark, landed) == []

    land(spark, landed, tmp_path, "orders", FILES["orders"], "2026-04-04")
    made = medallion.run_stale(spark, landed)
    assert "silver/products_enriched" not in names(made) and "bronze/products" not in names(made)
    assert {"silver/orders_clean", "gold/orders_by_period", "gold/top_products"} <= names(made)


def test_a_load_under_the_same_label_is_noticed(spark, landed, tmp_path):
    medallion.run_stale(spark, landed)
    land(spark, landed, tmp_path, "order_products_train", FILES["order_products_train"], "2026-04-01")
    assert names(medallion.run_stale(spark, landed)) == {
        "bronze/order_products_train", "silver/order_items_train_enriched"
    }


def test_what_was_interrupted_or_lost_is_built_again(spark, landed):
    medallion.run_stale(spark, landed)
    root = landed.table("gold", "repurchase_metrics")
    # A write without a record, as when a run ends between the two.
    write_snapshot(read_snapshot(spark, root).limit(1), f"{root}-copy", "2026-04-01")
    write_snapshot(read_snapshot(spark, f"{root}-copy"), root, "2026-04-01")
    stale = {t for t, inputs in lineage.stale_inputs(spark, landed).items() if inputs}
    assert stale == {("gold", "repurchase_metrics")}
    assert names(medallion.run_stale(spark, landed)) == {"gold/repurchase_metrics"}
    assert read_snapshot(spark, root).count() == 3


def test_the_report_before_the_first_run(spark, landed):
    rows = lineage.report(spark, landed).collect()
    assert len(rows) == sum(map(len, lineage.INPUTS.values()))
    assert all(r.stale and r.label is None and not r.mixed for r in rows)


def test_runs_by_layer_are_recorded_too(spark, landed):
    medallion.run(spark, landed)
    assert medallion.run_stale(spark, landed) == []
    assert {(r.label, r.stale) for r in lineage.report(spark, landed).collect()} == {("2026-04-01", False)}
