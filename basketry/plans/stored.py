"""The layers stored once per application, for queries that each run one step of them.

A query for a silver table reads stored bronze tables, a query for a gold table
reads stored silver tables, and so on. What a step needs and is not yet there is
built with ``medallion`` from the driver tables, in the shared work folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from basketry.contracts import ENTITIES, LAYERS, contract
from basketry.functions.together import together
from basketry.plans import driver_tables, medallion
from basketry.sources import buckets, paths, raw
from basketry.sources.snapshots import read_snapshot, snapshot_path, write_snapshot

LABEL = "2026-04-02"
SNAPSHOT = f"ingestion_date={LABEL}"

_BASES: dict[tuple[str, str], str] = {}


def _base(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BASES or not paths.exists(spark, _BASES[key]):
        _BASES[key] = paths.work_folder(spark, "layers")
    return _BASES[key]


def roots(spark: SparkSession, sf_dir: str) -> medallion.Roots:
    return medallion.Roots.under(_base(spark, sf_dir))


def folder(spark: SparkSession, sf_dir: str, name: str, fill: Callable[[str], None]) -> str:
    """A folder of that name beside the layers, filled once per application."""
    at = f"{_base(spark, sf_dir)}/{name}"
    if not paths.exists(spark, f"{at}/_filled"):
        fill(at)
        spark.range(0).write.mode("overwrite").parquet(f"{at}/_filled")
    return at


def sources(spark: SparkSession, sf_dir: str, *entities: str) -> str:
    """The folder of the CSV sources, with those of some entities, by default all six."""
    at = f"{_base(spark, sf_dir)}/source"
    write = partial(driver_tables.write_source_files, spark, sf_dir, at)
    steps = [partial(folder, spark, sf_dir, f"source-of/{e}", lambda _, e=e: write(e)) for e in entities or ENTITIES]
    together(spark, steps)
    return at


def _missing(spark: SparkSession, root: str) -> bool:
    return not paths.exists(spark, snapshot_path(root, LABEL))


def raw_root(spark: SparkSession, sf_dir: str, *entities: str) -> str:
    """The raw layer, with some entities landed from their sources, by default all six."""
    at = roots(spark, sf_dir)
    absent = [e for e in entities or ENTITIES if _missing(spark, at.table("raw", e))]
    if absent == list(ENTITIES):
        raw.land_sources(spark, sources(spark, sf_dir), at.raw, LABEL)
    elif absent:
        source = sources(spark, sf_dir, *absent)
        lines = {e: raw.read_lines(spark, f"{source}/{ENTITIES[e].file_name}") for e in absent}
        together(spark, [partial(raw.land_lines, x, at.table("raw", e), LABEL) for e, x in lines.items()])
    return at.raw


def raw_table(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """A landed raw table, with the file each row came from."""
    return raw.read_raw(spark, raw_root(spark, sf_dir, entity), entity, LABEL)[0]


def bronze_table(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    at = roots(spark, sf_dir)
    if _missing(spark, at.table("bronze", entity)):
        raw_table(spark, sf_dir, entity)
        medallion.run_bronze(spark, at, entity)
    return read_snapshot(
        spark, at.table("bronze", entity), LABEL, contract("bronze", entity)
    )


def silver_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    at = roots(spark, sf_dir)
    if _missing(spark, at.table("silver", table)):
        _BUILD[table](spark, sf_dir, at)
    return read_snapshot(spark, at.table("silver", table), LABEL, contract("silver", table))


def in_buckets(spark: SparkSession, sf_dir: str, layer: str, table: str) -> buckets.Bucketed:
    """A stored table of items or orders in buckets of order_id."""
    whole = {"bronze": bronze_table, "silver": silver_table}[layer]

    def fill(at: str) -> None:
        df = whole(spark, sf_dir, table)
        # Of all sources, so that tables that meet have equal numbers.
        count = buckets.enough(spark, paths.total_size(spark, sources(spark, sf_dir)))
        buckets.store(df, at, "order_id", count)

    return buckets.load(spark, folder(spark, sf_dir, f"buckets-{layer}-{table}", fill))


def _build_orders(spark: SparkSession, sf_dir: str, at: medallion.Roots) -> None:
    bronze_table(spark, sf_dir, "orders")
    medallion.run_orders_clean(spark, at)


def _build_products(spark: SparkSession, sf_dir: str, at: medallion.Roots) -> None:
    for entity in ("products", "aisles", "departments"):
        bronze_table(spark, sf_dir, entity)
    medallion.run_products_enriched(spark, at)


def _build_items(source: str) -> Callable[[SparkSession, str, medallion.Roots], None]:
    def build(spark: SparkSession, sf_dir: str, at: medallion.Roots) -> None:
        raw_root(spark, sf_dir, f"order_products_{source}", "orders", "products", "aisles", "departments")
        bronze_table(spark, sf_dir, f"order_products_{source}")
        silver_table(spark, sf_dir, "orders_clean")
        silver_table(spark, sf_dir, "products_enriched")
        medallion.run_order_items(spark, at, source)

    return build


_BUILD = {
    "orders_clean": _build_orders,
    "products_enriched": _build_products,
    "order_items_prior_enriched": _build_items("prior"),
    "order_items_train_enriched": _build_items("train"),
}


def gold_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A gold table; the two rankings are built together, the calendar needs no items."""
    at = roots(spark, sf_dir)
    if _missing(spark, at.table("gold", table)):
        if table == "orders_by_period":
            silver_table(spark, sf_dir, "orders_clean")
            medallion.run_orders_by_period(spark, at)
        else:
            silver_table(spark, sf_dir, "order_items_prior_enriched")
            medallion.run_product_rankings(spark, at)
    return read_snapshot(spark, at.table("gold", table), LABEL, contract("gold", table))


def stored_as_is(spark: SparkSession, sf_dir: str, layer: str, table: str) -> DataFrame:
    """A stored table with all its columns, whatever its contract says."""
    if layer == "raw":
        return raw.scan_raw(spark, raw_root(spark, sf_dir, table), table, LABEL)[0]
    {"bronze": bronze_table, "silver": silver_table, "gold": gold_table}[layer](spark, sf_dir, table)
    return read_snapshot(spark, roots(spark, sf_dir).table(layer, table), LABEL)


def build_all(spark: SparkSession, sf_dir: str) -> None:
    """Build the layers of which nothing is there, tables that do not need each other side by side."""
    at = roots(spark, sf_dir)
    raw_root(spark, sf_dir)
    for layer in medallion.LAYER_ORDER:
        if all(_missing(spark, at.table(layer, t)) for t in LAYERS[layer]):
            medallion.run_layer(spark, at, layer)
        for t in LAYERS[layer]:
            stored_as_is(spark, sf_dir, layer, t)


def damaged(spark: SparkSession, sf_dir: str, layer: str, table: str) -> dict[str, DataFrame]:
    """Stored copies of a table that break its contract: one in its columns, one without rows."""
    kind = contract(layer, table)

    def fill(at: str) -> None:
        whole = stored_as_is(spark, sf_dir, layer, table).select(*kind.fieldNames())
        broken = {"damaged": driver_tables.damaged(whole, kind), "empty": whole.limit(0)}
        for name, df in broken.items():
            if layer == "raw":
                driver_tables.write_csv(df, f"{at}/{name}/{SNAPSHOT}/{ENTITIES[table].file_name}")
            else:
                write_snapshot(df, f"{at}/{name}", LABEL)

    at = folder(spark, sf_dir, f"broken/{layer}/{table}", fill)
    if layer == "raw":
        file = f"{SNAPSHOT}/{ENTITIES[table].file_name}"
        return {n: raw.scan_csv(spark, f"{at}/{n}/{file}") for n in ("damaged", "empty")}
    return {n: read_snapshot(spark, f"{at}/{n}", LABEL) for n in ("damaged", "empty")}


def all_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        e: raw_table(spark, sf_dir, e).select(*spec.columns) for e, spec in ENTITIES.items()
    }


def all_bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {e: bronze_table(spark, sf_dir, e) for e in ENTITIES}
