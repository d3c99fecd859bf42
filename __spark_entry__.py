"""

The six raw tables are derived from the driver tables (``basketry.plans.driver_tables``).
A query for a table of one layer reads the stored tables of the layers below it
(``basketry.plans.stored``). Audit columns (processing times, file paths) differ
from run to run and are dropped.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The file may be loaded by its path, from any directory.
if str(Path(__file__).parent) not in sys.path:
    sys.path.insert(0, str(Path(__file__).parent))

import oracle_queries
from basketry.contracts import AUDIT_COLUMNS, ENTITIES, LAYERS, PRODUCT_KEYS
from basketry.functions.skew import placing
from basketry.operators import drift, gold, quality, questions, silver
from basketry.operators.bronze import to_bronze
from basketry.plans import driver_tables, lineage, medallion, stored
from basketry.sources import paths, raw, snapshots

# The operators on training text are a part of their own; the rest works without them.
try:
    import corpus_pipeline
    from basketry.llm import queries as llm_queries
except ModuleNotFoundError as error:
    if not (error.name or "").startswith(("corpus_pipeline", "basketry.llm")):
        raise
    corpus_pipeline = llm_queries = None

LABEL = stored.LABEL
OLD_LABEL = oracle_queries.OLD_LABEL

Query = Callable[[SparkSession, str], DataFrame]


def _bronze(spark: SparkSession, sf_dir: str, entity: str, label: str = LABEL) -> DataFrame:
    return to_bronze(stored.raw_table(spark, sf_dir, entity), entity, label)


def _silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    bronze = partial(stored.bronze_table, spark, sf_dir)
    if table == "orders_clean":
        return silver.orders_clean(bronze("orders"))
    if table == "products_enriched":
        return silver.products_enriched(bronze("products"), bronze("aisles"), bronze("departments"))
    source = table.split("_")[2]
    return silver.order_items_enriched(
        bronze(f"order_products_{source}"),
        stored.silver_table(spark, sf_dir, "orders_clean"),
        stored.silver_table(spark, sf_dir, "products_enriched"),
    )


def _gold(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    if table == "orders_by_period":
        return gold.orders_by_period(stored.silver_table(spark, sf_dir, "orders_clean"))
    items = stored.silver_table(spark, sf_dir, "order_items_prior_enriched")
    build = {"top_products": gold.top_products, "repurchase_metrics": gold.repurchase_metrics}
    return build[table](items, **placing(items, PRODUCT_KEYS[0]))


_LAYER_TABLE = {"bronze": _bronze, "silver": _silver, "gold": _gold}


def _table(spark: SparkSession, sf_dir: str, layer: str, table: str) -> DataFrame:
    return _LAYER_TABLE[layer](spark, sf_dir, table).drop(*AUDIT_COLUMNS)


def _contract_report(spark: SparkSession, sf_dir: str, layer: str, table: str) -> DataFrame:
    """Reports on the stored table and on two stored copies that break its contract."""
    snapshots_of = {
        "stored": stored.stored_as_is(spark, sf_dir, layer, table),
        **stored.damaged(spark, sf_dir, layer, table),
    }
    return quality.union_reports(
        [
            quality.contract_report(df, layer, table).select(F.lit(name).alias("snapshot"), "*")
            for name, df in snapshots_of.items()
        ]
    )


def dq_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.union_reports([_contract_report(spark, sf_dir, "raw", e) for e in ENTITIES])


# Sources and snapshots: run the operator on the stored files and return what it gives.


def src_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the whole sources and of a folder that lacks all but the two smallest."""
    whole = stored.sources(spark, sf_dir)
    few = partial(driver_tables.write_source_files, spark, sf_dir)
    part = stored.folder(spark, sf_dir, "some", lambda at: few(at, "aisles", "departments"))
    return raw.source_manifest(spark, whole).withColumn("folder", F.lit("whole")).unionByName(
        raw.source_manifest(spark, part).withColumn("folder", F.lit("part"))
    )


def raw_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all six entities, each with the columns of its own."""
    tables = [
        stored.raw_table(spark, sf_dir, e).drop(*AUDIT_COLUMNS).withColumn("entity", F.lit(e))
        for e in ENTITIES
    ]
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def raw_landing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each entity has files and whether their sizes are what the file system says."""
    root = stored.raw_root(spark, sf_dir)
    listed = [(e, paths.total_size(spark, f"{root}/{e}/{stored.SNAPSHOT}")) for e in ENTITIES]
    listed = spark.createDataFrame(listed, "entity string, listed bigint")
    return raw.landing_summary(spark, root, LABEL).join(listed, "entity").select(
        "entity",
        (F.col("files") > 0).alias("has_files"),
        (F.col("bytes") == F.col("listed")).alias("bytes_agree"),
    )


def _scan_csv(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    scan = raw.scan_csv(spark, f"{stored.sources(spark, sf_dir)}/{ENTITIES[entity].file_name}")
    return scan.select(*ENTITIES[entity].columns)


def scan_csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose names hold line breaks and quotes, landed as lines and put together by block."""

    def fill(at: str) -> None:
        products = driver_tables.raw_products_in_lines(spark, sf_dir)
        driver_tables.write_csv(products, f"{at}/source", raw.RFC4180)
        snapshots.write_snapshot(raw.read_lines(spark, f"{at}/source"), f"{at}/products", LABEL)

    at = stored.folder(spark, sf_dir, "in-lines", fill)
    return raw.read_raw(spark, at, "products", LABEL, raw.RFC4180)[0].drop("source_file_name")


def scan_parquet_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{paths.work_folder(spark, 'bronze')}/orders"
    snapshots.write_snapshot(_bronze(spark, sf_dir, "orders"), root, LABEL)
    stored = snapshots.read_snapshot(spark, root, LABEL, LAYERS["bronze"]["orders"])
    return stored.drop(*AUDIT_COLUMNS)


def _two_product_snapshots(spark: SparkSession, sf_dir: str) -> str:
    """An older snapshot of the products with an aisle only, a newer one of all."""
    root = f"{paths.work_folder(spark, 'bronze')}/products"
    for label in (OLD_LABEL, LABEL):
        table = _bronze(spark, sf_dir, "products", label)
        some = table if label == LABEL else table.where(F.col("aisle_id") < 30)
        snapshots.write_snapshot(some, root, label)
    return root


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_product_snapshots(spark, sf_dir)
    label = snapshots.latest_snapshot(spark, root)
    stored = snapshots.read_snapshot(spark, root, label)
    return stored.groupBy(F.lit(label).alias("ingestion_date"), "raw_ingestion_date").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def snapshot_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_product_snapshots(spark, sf_dir)
    files = spark.read.parquet(root).select(F.col("_metadata.file_path").alias("path"))
    label = snapshots.snapshot_label_of(F.col("path")).alias("ingestion_date")
    return files.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))


def snapshot_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _two_product_snapshots(spark, sf_dir)
    # A second load of the newer snapshot replaces it by other rows and leaves the older one.
    again = _bronze(spark, sf_dir, "products", LABEL).where(F.col("department_id") <= 3)
    snapshots.write_snapshot(again, root, LABEL)
    both = [
        snapshots.read_snapshot(spark, root, label).withColumn("ingestion_date", F.lit(label))
        for label in (OLD_LABEL, LABEL)
    ]
    return both[0].unionByName(both[1]).drop(*AUDIT_COLUMNS)


def snapshot_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = paths.work_folder(spark, "bronze")
    written = [
        snapshots.write_snapshot(_bronze(spark, sf_dir, e), f"{base}/{e}", LABEL) for e in ENTITIES
    ]
    return snapshots.summary_frame(spark, written)


def _end_to_end(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """CSV sources through every layer, table by table; one run serves all three gold tables."""

    def fill(at: str) -> None:
        run = medallion.Roots.under(at)
        raw.land_sources(spark, stored.sources(spark, sf_dir), run.raw, LABEL)
        medallion.run(spark, run)

    at = medallion.Roots.under(stored.folder(spark, sf_dir, "end-to-end", fill))
    return snapshots.read_snapshot(spark, at.table("gold", table)).drop(*AUDIT_COLUMNS)


def run_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs of all tables after the aisles alone were landed anew, and after building what that made stale."""

    def fill(at: str) -> None:
        run, source = medallion.Roots.under(f"{at}/layers"), stored.sources(spark, sf_dir)
        raw.land_sources(spark, source, run.raw, OLD_LABEL)
        medallion.run_stale(spark, run)
        aisles = raw.read_lines(spark, f"{source}/{ENTITIES['aisles'].file_name}")
        snapshots.write_snapshot(aisles, f"{run.raw}/aisles", LABEL)
        lineage.report(spark, run).write.parquet(f"{at}/landed")
        snapshots.summary_frame(spark, medallion.run_stale(spark, run)).write.parquet(f"{at}/written")
        lineage.report(spark, run).write.parquet(f"{at}/built")

    at = stored.folder(spark, sf_dir, "stale", fill)
    phases = [spark.read.parquet(f"{at}/{p}").withColumn("phase", F.lit(p)) for p in ("landed", "built")]
    written = spark.read.parquet(f"{at}/written").select(F.col("table_name").alias("name"), "row_count")
    return (
        quality.union_reports(phases)
        .withColumn("name", F.substring_index("table_name", ".", -1))
        .join(written, "name", "left")
        .drop("name")
    )


def silver_items_in_buckets(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Items and orders joined where they lie, in buckets of the order."""
    items = stored.in_buckets(spark, sf_dir, "bronze", f"order_products_{source}")
    orders = stored.in_buckets(spark, sf_dir, "silver", "orders_clean")
    products = stored.silver_table(spark, sf_dir, "products_enriched")
    return silver.order_items_from_buckets(items, orders, products).drop(*AUDIT_COLUMNS)


def gold_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products ranked from a state of the first orders and two more loads, merged one after the other."""

    def fill(at: str) -> None:
        run = medallion.Roots.under(at)
        items = stored.silver_table(spark, sf_dir, _ITEMS)
        load = F.when(F.col("order_id") % 10 < 7, 0).when(F.col("order_id") % 10 < 9, 1).otherwise(2)
        for number, label in enumerate(("2026-04-01", "2026-04-02", "2026-04-03")):
            snapshots.write_snapshot(items.where(load == number), run.table("silver", _ITEMS), label)
            medallion.update_product_rankings(spark, run)

    at = medallion.Roots.under(stored.folder(spark, sf_dir, "updated", fill))
    tables = [
        snapshots.read_snapshot(spark, at.table("gold", t), "2026-04-03").withColumn("ranking", F.lit(t))
        for t in ("top_products", "repurchase_metrics")
    ]
    return tables[0].unionByName(tables[1], allowMissingColumns=True).drop(*AUDIT_COLUMNS)


def dq_source_raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For the raw layer, and for a copy of it that lacks a line of the departments."""
    source, root = stored.sources(spark, sf_dir), stored.raw_root(spark, sf_dir)

    def fill(at: str) -> None:
        lines = raw.landed_lines(spark, root, "departments", LABEL)[0]
        lowest = lines.agg(F.min("line")).scalar()  # a row, since headers sort after digits
        snapshots.write_snapshot(lines.where(F.col("line") != lowest), f"{at}/departments", LABEL)

    short = stored.folder(spark, sf_dir, "short", fill)
    records = {e.name: quality.source_records(spark, f"{source}/{e.file_name}") for e in ENTITIES.values()}
    whole = {e: raw.read_raw(spark, root, e)[0] for e in ENTITIES}
    reports = {
        "whole": quality.source_raw_counts(records, whole),
        "short": quality.source_raw_counts(
            records, whole | {"departments": raw.read_raw(spark, short, "departments")[0]}
        ),
    }
    return quality.union_reports(
        [report.withColumn("landing", F.lit(name)) for name, report in reports.items()]
    )


def dq_source_raw_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For the raw layer, and for a copy of it in which a line of the aisles is another."""
    source, root = stored.sources(spark, sf_dir), stored.raw_root(spark, sf_dir)

    def fill(at: str) -> None:
        lines = raw.landed_lines(spark, root, "aisles", LABEL)[0]
        lowest = lines.agg(F.min("line")).scalar()  # a row, since headers sort after digits
        line = F.when(F.col("line") == lowest, F.concat("line", F.lit("?"))).otherwise(F.col("line"))
        snapshots.write_snapshot(lines.withColumn("line", line), f"{at}/aisles", LABEL)

    changed = stored.folder(spark, sf_dir, "changed", fill)
    given = {e.name: raw.read_lines(spark, f"{source}/{e.file_name}") for e in ENTITIES.values()}
    whole = {e: raw.landed_lines(spark, root, e, LABEL)[0] for e in ENTITIES}
    other = whole | {"aisles": raw.landed_lines(spark, changed, "aisles", LABEL)[0]}
    reports = [
        quality.content_report(given, landed).withColumn("landing", F.lit(name))
        for name, landed in (("whole", whole), ("changed", other))
    ]
    # Names of files and where they are divided are other in each run; the sides and their number are not.
    sides = F.array_join(F.array_distinct(F.transform("differing_blocks", lambda b: F.substring_index(b, ":", 1))), ",")
    counted = quality.union_reports(reports).withColumn("sides", F.array_join(F.array_sort(F.split(sides, ",")), ","))
    rows = quality.union_reports(
        [quality.source_records(spark, f"{source}/{e.file_name}").withColumn("entity", F.lit(e.name)) for e in ENTITIES.values()]
    )
    return counted.drop("differing_blocks").join(rows, "entity")


def dq_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders as they are, the same again, and with other hours and fewer days, each compared with the load before."""

    def fill(at: str) -> None:
        orders = stored.silver_table(spark, sf_dir, _ORDERS).drop(*AUDIT_COLUMNS)
        some = F.when(F.col("order_id") % 3 != 0, F.col("days_since_prior_order"))
        shifted = orders.withColumns(
            {"order_hour_of_day": F.floor(F.col("order_hour_of_day") / 3).cast("int"), "days_since_prior_order": some}
        )
        for label, load in (("2026-04-01", orders), ("2026-04-02", orders), ("2026-04-03", shifted)):
            found = drift.follow(spark, load, f"{at}/history", label)
            if found is not None:
                snapshots.write_snapshot(found, f"{at}/drift", label)

    at = stored.folder(spark, sf_dir, "drift", fill)
    loads = [
        snapshots.read_snapshot(spark, f"{at}/drift", label).withColumn("run_label", F.lit(label))
        for label in ("2026-04-02", "2026-04-03")
    ]
    # The distances are estimates of sketches.
    return quality.union_reports(loads).drop("rank_distance", "different_factor")


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports of every table of all layers, stored in one write and read again."""
    path = f"{paths.work_folder(spark, 'reports')}/all"
    stored.build_all(spark, sf_dir)
    reports = [
        quality.contract_report(stored.stored_as_is(spark, sf_dir, layer, t), layer, t)
        for layer, tables in LAYERS.items()
        for t in tables
    ]
    quality.save_report(quality.union_reports(reports), path, LABEL)
    return spark.read.parquet(path)


def _question(spark: SparkSession, sf_dir: str, ask: Callable, table: str) -> DataFrame:
    return ask(stored.silver_table(spark, sf_dir, table))


_ITEMS, _ORDERS = "order_items_prior_enriched", "orders_clean"
_QUESTIONS = {
    "q_department_volume": (questions.department_volume, _ITEMS),
    "q_aisle_share": (questions.aisle_share, _ITEMS),
    "q_basket_size": (questions.basket_size, _ITEMS),
    "q_order_interval": (questions.order_interval, _ORDERS),
    "q_successive_products": (questions.successive_products, _ITEMS),
    "q_department_repurchase": (questions.department_repurchase, _ITEMS),
    "q_user_frequency": (questions.user_frequency, _ORDERS),
    "q_cohort_retention": (questions.cohort_retention, _ORDERS),
    "q_basket_evolution": (questions.basket_evolution, _ITEMS),
    "q_basket_similarity": (questions.basket_similarity, _ITEMS),
    "q_order_survival": (questions.order_survival, _ORDERS),
    "q_frequency_ranks": (questions.frequency_ranks, _ORDERS),
    "gold_rollup": (gold.purchase_rollup, _ITEMS),
}


def entry(spark: SparkSession) -> DataFrame:
    """Products ranked by purchases, at the smallest scale."""
    return queries()["gold_top_products"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for layer in ("bronze", "silver", "gold"):
        for t in LAYERS[layer]:
            out[f"{layer}_{t}"] = partial(_table, layer=layer, table=t)
    out["dq_raw"] = dq_raw
    for layer in ("bronze", "silver", "gold"):
        for t in LAYERS[layer]:
            out[f"dq_{layer}_{t}"] = partial(_contract_report, layer=layer, table=t)
    out |= {
        "src_manifest": src_manifest,
        "raw_landing": raw_landing,
        "raw_landing_summary": raw_landing_summary,
        **{f"scan_csv_{e}": partial(_scan_csv, entity=e) for e in ENTITIES},
        "scan_csv_multiline": scan_csv_multiline,
        "scan_parquet_snapshot": scan_parquet_snapshot,
        "latest_snapshot": latest_snapshot,
        "snapshot_label": snapshot_label,
        "snapshot_overwrite": snapshot_overwrite,
        "snapshot_summary": snapshot_summary,
        **{f"silver_{s}_in_buckets": partial(silver_items_in_buckets, source=s) for s in ("prior", "train")},
        "run_stale": run_stale,
        "gold_updated": gold_updated,
        **{f"end_to_end_{t}": partial(_end_to_end, table=t) for t in LAYERS["gold"]},
        "dq_key_duplicates": lambda s, d: quality.key_duplicates(stored.all_bronze(s, d)),
        "dq_type_conformance": lambda s, d: quality.type_conformance(stored.all_raw(s, d)),
        "dq_source_raw_counts": dq_source_raw_counts,
        "dq_source_raw_content": dq_source_raw_content,
        "dq_drift": dq_drift,
        "dq_orphans": lambda s, d: quality.orphans(stored.all_bronze(s, d)),
        "dq_summary": dq_summary,
    }
    for name, (ask, table) in _QUESTIONS.items():
        out[name] = partial(_question, ask=ask, table=table)
    if llm_queries:
        out |= llm_queries.queries()
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    out = oracle_queries.oracle_sql()
    if llm_queries:
        out |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
