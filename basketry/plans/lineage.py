"""What each table is made of, from which snapshots it was made, and whether those are still the latest.

Beside the files of a snapshot lies a record of its inputs: the label of each and a digest of its files, so that a
load that replaces a snapshot under the same label is noticed too. Readers of the snapshot don't see the record, and it
goes with the snapshot when that is overwritten.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from basketry.contracts import ENTITIES, LAYERS
from basketry.sources import paths
from basketry.sources.snapshots import latest_snapshot, snapshot_path

Table = tuple[str, str]  # layer, name

#: The inputs of each table; an output takes its label from the first.
INPUTS: dict[Table, list[Table]] = {
    **{("bronze", e): [("raw", e)] for e in ENTITIES},
    ("silver", "orders_clean"): [("bronze", "orders")],
    ("silver", "products_enriched"): [("bronze", e) for e in ("products", "aisles", "departments")],
    **{
        ("silver", f"order_items_{source}_enriched"): [
            ("bronze", f"order_products_{source}"),
            ("silver", "orders_clean"),
            ("silver", "products_enriched"),
        ]
        for source in ("prior", "train")
    },
    ("gold", "orders_by_period"): [("silver", "orders_clean")],
    ("gold", "top_products"): [("silver", "order_items_prior_enriched")],
    ("gold", "repurchase_metrics"): [("silver", "order_items_prior_enriched")],
}
TABLES: list[Table] = [(layer, name) for layer in ("bronze", "silver", "gold") for name in LAYERS[layer]]
_RECORD = "_inputs.json"


@dataclass(frozen=True)
class Version:
    """A snapshot of a table as it lies there."""

    layer: str
    name: str
    label: str
    digest: str

    @property
    def table(self) -> Table:
        return self.layer, self.name


def version(spark: SparkSession, roots, table: Table, label: str | None = None) -> Version:
    """One snapshot of a table, by default the latest."""
    root = roots.table(*table)
    label = label or latest_snapshot(spark, root)
    files = sorted(map(str, paths.data_files(spark, snapshot_path(root, label))))
    return Version(*table, label, hashlib.sha256("\n".join(files).encode()).hexdigest()[:16])


def inputs(spark: SparkSession, roots, table: Table) -> list[Version]:
    """The latest snapshots of what a table is made of."""
    return [version(spark, roots, t) for t in INPUTS[table]]


def record(spark: SparkSession, roots, table: Table, label: str, made_of: list[Version]) -> None:
    listed = [vars(v) for v in made_of]
    paths.write_text(spark, f"{snapshot_path(roots.table(*table), label)}/{_RECORD}", json.dumps(listed))


def recorded(spark: SparkSession, roots, table: Table) -> list[Version]:
    """What the latest snapshot of a table was made of; nothing if that is not known or there is none."""
    try:
        label = latest_snapshot(spark, roots.table(*table))
    except FileNotFoundError:
        return []
    at = f"{snapshot_path(roots.table(*table), label)}/{_RECORD}"
    return [Version(**v) for v in json.loads(paths.read_text(spark, at))] if paths.exists(spark, at) else []


def stale_inputs(spark: SparkSession, roots) -> dict[Table, set[Table]]:
    """For each table, in the order of building, the inputs for which it has to be built again.

    These are inputs whose latest snapshot is not the recorded one, and inputs that have to be built again
    themselves. For a table without a record they are all of its inputs.
    """
    found: dict[Table, set[Table]] = {}
    for table in TABLES:
        made_of = {v.table: v for v in recorded(spark, roots, table)}
        again = {t for t in INPUTS[table] if found.get(t)}
        known = [t for t in INPUTS[table] if t in made_of and t not in again]
        others = {t for t in INPUTS[table] if t not in made_of}
        found[table] = again | others | {t for t in known if version(spark, roots, t) != made_of[t]}
    return found


def mixed_labels(spark: SparkSession, roots, table: Table) -> list[str]:
    """The labels that a table's inputs had when it was made, if they are not all the same."""
    labels = sorted({v.label for v in recorded(spark, roots, table)})
    return labels if len(labels) > 1 else []


def report(spark: SparkSession, roots) -> DataFrame:
    """One row for each table and input: the label it was made from (NULL if not recorded), whether the input
    is stale, and whether the table mixes labels.
    """
    rows = []
    for table, stale in stale_inputs(spark, roots).items():
        made_of = {v.table: v.label for v in recorded(spark, roots, table)}
        mixed = len(set(made_of.values())) > 1
        rows += [(".".join(table), ".".join(t), made_of.get(t), t in stale, mixed) for t in INPUTS[table]]
    return spark.createDataFrame(rows, "table_name string, input_name string, label string, stale boolean, mixed boolean")
