"""Runs the layers over stored snapshots: raw -> bronze -> silver -> gold.

Every function reads the latest snapshot of each input, writes one snapshot per
table and returns what it wrote. A table is written once and read back by the
next layer, so a lost executor costs at most the tasks of the current table.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from basketry.contracts import ENTITIES, PRODUCT_KEYS, contract
from basketry.functions.skew import placing
from basketry.functions.together import together
from basketry.operators import gold, silver
from basketry.operators.bronze import to_bronze
from basketry.plans import lineage
from basketry.plans.lineage import Version
from basketry.sources import paths
from basketry.sources.raw import DEFAULT, Dialect, read_raw
from basketry.sources.snapshots import SnapshotSummary, read_snapshot, snapshot_labels, write_snapshot

LAYER_ORDER = ["bronze", "silver", "gold"]
_ITEMS = "order_items_prior_enriched"
_ITEM_TABLES = [("silver", f"order_items_{s}_enriched") for s in ("prior", "train")]
_ALL_MEASURES = "repurchase_metrics"  # the ranking that has all columns of the other


@dataclass(frozen=True)
class Roots:
    """The base folder of each layer; a table lies in the folder of its name."""

    raw: str
    bronze: str
    silver: str
    gold: str

    @classmethod
    def under(cls, base: str) -> Roots:
        base = base.rstrip("/")
        return cls(*(f"{base}/{layer}" for layer in ("raw", *LAYER_ORDER)))

    def table(self, layer: str, name: str) -> str:
        return f"{getattr(self, layer).rstrip('/')}/{name}"


def _read(spark: SparkSession, roots: Roots, given: Version) -> DataFrame:
    kind = contract(given.layer, given.name)
    return read_snapshot(spark, roots.table(given.layer, given.name), given.label, kind)


def _write(
    spark: SparkSession, roots: Roots, layer: str, name: str, df: DataFrame, made_of: list[Version]
) -> SnapshotSummary:
    """Labelled like the first input; what it was made of is recorded once it is there."""
    summary = write_snapshot(df, roots.table(layer, name), made_of[0].label)
    lineage.record(spark, roots, (layer, name), summary.label, made_of)
    return summary


def run_bronze(
    spark: SparkSession,
    roots: Roots,
    entity: str,
    batch_time: datetime | None = None,
    dialect: Dialect = DEFAULT,
) -> SnapshotSummary:
    given = lineage.inputs(spark, roots, ("bronze", entity))
    label = given[0].label
    raw, _ = read_raw(spark, roots.raw, entity, label, dialect)
    return _write(spark, roots, "bronze", entity, to_bronze(raw, entity, label, batch_time), given)


def run_orders_clean(
    spark: SparkSession, roots: Roots, batch_time: datetime | None = None
) -> SnapshotSummary:
    given = lineage.inputs(spark, roots, ("silver", "orders_clean"))
    table = silver.orders_clean(_read(spark, roots, given[0]), batch_time)
    return _write(spark, roots, "silver", "orders_clean", table, given)


def run_products_enriched(
    spark: SparkSession, roots: Roots, batch_time: datetime | None = None
) -> SnapshotSummary:
    """Labelled like the products; aisles and departments use their own latest snapshot."""
    given = lineage.inputs(spark, roots, ("silver", "products_enriched"))
    table = silver.products_enriched(*(_read(spark, roots, v) for v in given), batch_time)
    return _write(spark, roots, "silver", "products_enriched", table, given)


def run_order_items(
    spark: SparkSession, roots: Roots, source: str, batch_time: datetime | None = None
) -> SnapshotSummary:
    """``source`` is prior or train. Labelled like the items; the rest uses its own latest."""
    name = f"order_items_{source}_enriched"
    given = lineage.inputs(spark, roots, ("silver", name))
    table = silver.order_items_enriched(*(_read(spark, roots, v) for v in given), batch_time)
    return _write(spark, roots, "silver", name, table, given)


def run_orders_by_period(
    spark: SparkSession, roots: Roots, batch_time: datetime | None = None
) -> SnapshotSummary:
    given = lineage.inputs(spark, roots, ("gold", "orders_by_period"))
    table = gold.orders_by_period(_read(spark, roots, given[0]), batch_time)
    return _write(spark, roots, "gold", "orders_by_period", table, given)


def run_product_rankings(
    spark: SparkSession,
    roots: Roots,
    batch_time: datetime | None = None,
    tables: tuple[str, ...] = ("top_products", "repurchase_metrics"),
) -> list[SnapshotSummary]:
    """The product rankings from one pass over the items.

    The repurchase metrics hold every measure, so they are written first and the other ranking is made of
    them as they were written. Nothing is persisted, whose shuffles would stay on disk.
    """
    given = lineage.inputs(spark, roots, ("gold", "top_products"))  # those of the other ranking, too
    items = _read(spark, roots, given[0])
    measures = gold.product_measures(items, **placing(items, PRODUCT_KEYS[0]))
    written = {}
    for t in sorted(tables, key=lambda t: t != _ALL_MEASURES):
        written[t] = _write(spark, roots, "gold", t, gold.product_ranking(measures, t, batch_time), given)
        if t == _ALL_MEASURES:
            measures = read_snapshot(spark, roots.table("gold", t), written[t].label)
    return [written[t] for t in tables]


def update_product_rankings(
    spark: SparkSession, roots: Roots, batch_time: datetime | None = None
) -> list[SnapshotSummary]:
    """The product rankings where each snapshot of the items brings the orders since the one before.

    A state for each product and customer is kept under the label up to which it goes. It is merged with
    the state of the newer snapshots, and only these are read. An order must come whole in one
    snapshot. Without newer ones nothing is written.
    """
    items_root, state_root = roots.table("silver", _ITEMS), roots.table("gold", "product_state")
    known = snapshot_labels(spark, state_root) if paths.exists(spark, state_root) else []
    new = [v for v in snapshot_labels(spark, items_root) if not known or v > known[-1]]
    if not new:
        return []
    kind = contract("silver", _ITEMS)
    delta = read_snapshot(spark, items_root, new[0], kind)
    for label in new[1:]:
        delta = delta.unionByName(read_snapshot(spark, items_root, label, kind))
    placed = placing(delta, PRODUCT_KEYS[0])
    if known:
        before = read_snapshot(spark, state_root, known[-1])
        # A product that is hot in neither is not hot in both, where it has at most a row for each of its items.
        both = placed["place_by_key"] and placing(before, PRODUCT_KEYS[0])["place_by_key"]
        state = gold.purchase_state(delta, PRODUCT_KEYS, place_by_user=placed["place_by_user"] and not both, place_by_key=both)
        state = gold.merge_states([before, state], PRODUCT_KEYS, place_by_key=both)
    else:
        state = gold.purchase_state(delta, PRODUCT_KEYS, **placed)
    write_snapshot(state, state_root, new[-1])
    measures = gold.measures_of(read_snapshot(spark, state_root, new[-1]), PRODUCT_KEYS)
    measures.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [
            write_snapshot(gold.product_ranking(measures, t, batch_time), roots.table("gold", t), new[-1])
            for t in ("top_products", "repurchase_metrics")
        ]
    finally:
        measures.unpersist()


def run_layer(
    spark: SparkSession,
    roots: Roots,
    layer: str,
    batch_time: datetime | None = None,
    dialect: Dialect = DEFAULT,
) -> list[SnapshotSummary]:
    """The tables of one layer; those that do not need each other are built side by side, but for those of items.

    Each of these fills a cluster by itself. One after the other, what their joins shuffle does not lie on disk
    at the same time.
    """
    if layer == "bronze":
        return together(
            spark, [partial(run_bronze, spark, roots, e, batch_time, dialect) for e in ENTITIES]
        )
    if layer == "silver":
        dimensions = [run_orders_clean, run_products_enriched]
        return [
            *together(spark, [partial(step, spark, roots, batch_time) for step in dimensions]),
            *together(
                spark,
                [partial(run_order_items, spark, roots, s, batch_time) for s in ("prior", "train")],
                at_once=1,
            ),
        ]
    period, rankings = together(
        spark,
        [
            lambda: [run_orders_by_period(spark, roots, batch_time)],
            lambda: run_product_rankings(spark, roots, batch_time),
        ],
    )
    return period + rankings


def run(
    spark: SparkSession,
    roots: Roots,
    upto: str = "gold",
    batch_time: datetime | None = None,
    dialect: Dialect = DEFAULT,
) -> list[SnapshotSummary]:
    """All layers up to ``upto``, from landed raw snapshots."""
    wanted = LAYER_ORDER[: LAYER_ORDER.index(upto) + 1]
    return [s for layer in wanted for s in run_layer(spark, roots, layer, batch_time, dialect)]


def run_stale(
    spark: SparkSession, roots: Roots, batch_time: datetime | None = None, dialect: Dialect = DEFAULT
) -> list[SnapshotSummary]:
    """Build only the tables whose inputs have newer or other snapshots than those they were made of.

    Tables that do not need each other are built side by side, but for those of items, which are built one after
    the other as in ``run_layer``. With nothing to do nothing is written.
    """
    stale = [table for table, inputs in lineage.stale_inputs(spark, roots).items() if inputs]
    rankings = tuple(name for name in ("top_products", "repurchase_metrics") if ("gold", name) in stale)
    step = {
        **{("bronze", e): partial(run_bronze, spark, roots, e, batch_time, dialect) for e in ENTITIES},
        ("silver", "orders_clean"): partial(run_orders_clean, spark, roots, batch_time),
        ("silver", "products_enriched"): partial(run_products_enriched, spark, roots, batch_time),
        **{
            ("silver", f"order_items_{s}_enriched"): partial(run_order_items, spark, roots, s, batch_time)
            for s in ("prior", "train")
        },
        ("gold", "orders_by_period"): partial(run_orders_by_period, spark, roots, batch_time),
        **dict.fromkeys(
            [("gold", name) for name in rankings[:1]],
            partial(run_product_rankings, spark, roots, batch_time, rankings),
        ),
    }
    written, done = [], set()
    while waiting := [table for table in stale if table in step and table not in done]:
        ready = [t for t in waiting if not set(lineage.INPUTS[t]) & set(waiting)]
        items = [t for t in ready if t in _ITEM_TABLES]
        others = [t for t in ready if t not in items]
        one_by_one = partial(together, spark, [step[t] for t in items], at_once=1)
        *made, made_items = together(spark, [*(step[t] for t in others), one_by_one])
        made_of = dict(zip([*others, *items], [*made, *made_items], strict=True))
        for t in ready:
            written += made_of[t] if isinstance(made_of[t], list) else [made_of[t]]
        done.update(ready)
    return written
