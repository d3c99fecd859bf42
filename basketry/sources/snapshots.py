"""Tables kept as dated snapshots: ``<root>/ingestion_date=<label>/*.parquet``."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.contracts import SNAPSHOT_COLUMN
from basketry.functions.shuffles import freed_at_end
from basketry.sources import paths

_PREFIX = f"{SNAPSHOT_COLUMN}="


def snapshot_path(root: str, label: str) -> str:
    return f"{root.rstrip('/')}/{_PREFIX}{label}"


def snapshot_label(path: str) -> str:
    """The label in a snapshot directory name or in a path through one."""
    found = re.search(rf"(?:^|/){_PREFIX}([^/]+)", path)
    if not found:
        raise ValueError(f"not a snapshot path: {path}")
    return found.group(1)


def snapshot_label_of(path: Column) -> Column:
    """``snapshot_label`` for a column of file paths; NULL where there is none."""
    label = F.regexp_extract(path, rf"(?:^|/){_PREFIX}([^/]+)", 1)
    return F.nullif(label, F.lit(""))


def latest_snapshot(spark: SparkSession, root: str) -> str:
    """The greatest label, compared as text, among the snapshot directories.

    An empty directory counts: if the newest load left nothing, the reader is to
    fail and not to fall back silently to an older one.
    """
    labels = snapshot_labels(spark, root)
    if not labels:
        raise FileNotFoundError(f"no {_PREFIX}* directory in {root}")
    return labels[-1]


def snapshot_labels(spark: SparkSession, root: str) -> list[str]:
    """The labels of all snapshot directories, in order of their text."""
    names = paths.children(spark, root, directories_only=True)
    return sorted(n.removeprefix(_PREFIX) for n in names if n.startswith(_PREFIX))


def read_snapshot(
    spark: SparkSession, root: str, label: str | None = None, contract: StructType | None = None
) -> DataFrame:
    """One snapshot, by default the latest.

    The snapshot directory itself is read, so only its files are listed and no
    partition column appears. Given a contract, its columns are selected by name
    and a missing one is an error.
    """
    at = snapshot_path(root, label or latest_snapshot(spark, root))
    if not paths.exists(spark, at):
        raise FileNotFoundError(f"snapshot not found: {at}")
    if not paths.has_data_files(spark, at):
        raise FileNotFoundError(f"no data files in {at}")
    df = spark.read.parquet(at)
    return df if contract is None else df.select(*contract.fieldNames())


@dataclass(frozen=True)
class SnapshotSummary:
    root: str
    label: str
    rows: int


def write_snapshot(df: DataFrame, root: str, label: str) -> SnapshotSummary:
    """Replace one snapshot and leave the others alone, in a single job.

    The old files go only when the new ones are committed. The row count comes
    with the write. A result without rows would replace nothing, so it is written
    as an empty snapshot. What the write shuffles goes with it.
    """
    counted = Observation()
    out = (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .withColumn(SNAPSHOT_COLUMN, F.lit(label))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(SNAPSHOT_COLUMN)
    )
    with freed_at_end(df.sparkSession):
        out.parquet(root)
    rows = counted.get["rows"]
    if rows == 0:
        empty = df.sparkSession.createDataFrame([], df.schema)
        empty.write.mode("overwrite").parquet(snapshot_path(root, label))
    return SnapshotSummary(root, label, rows)


def preview(spark: SparkSession, summary: SnapshotSummary, rows: int = 20) -> DataFrame:
    """The first rows as written."""
    return read_snapshot(spark, summary.root, summary.label).limit(rows)


def summary_frame(spark: SparkSession, summaries: list[SnapshotSummary]) -> DataFrame:
    """Table name, label and row count of each written snapshot."""
    return spark.createDataFrame(
        [(s.root.rstrip("/").rsplit("/", 1)[-1], s.label, s.rows) for s in summaries],
        f"table_name string, {SNAPSHOT_COLUMN} string, row_count bigint",
    )
