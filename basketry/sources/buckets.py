"""Tables stored in buckets of a key, so that later joins on the key shuffle neither side.

Spark keeps the layout of buckets in its catalog, which another application does not see. It is therefore
also written beside the files, and the table is declared again when it is read. Keys that hold so many rows that one
task could not join them in time, and rows without a key, are stored apart, spread as they come.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.skew import hot_keys, uneven_share
from basketry.sources import paths


#: Bytes of text that a bucket holds, and the most buckets that Spark allows.
BYTES, MOST = 16 << 20, 100_000


@dataclass(frozen=True)
class Bucketed:
    """A stored table: rows in buckets of ``key``, and those of ``hot`` values and of none beside them."""

    key: str
    count: int
    buckets: DataFrame
    apart: DataFrame
    hot: list[int]

    def all(self) -> DataFrame:
        return self.buckets.unionByName(self.apart)


def _name(path: str) -> str:
    return f"buckets_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def enough(spark: SparkSession, size: int) -> int:
    """How many buckets hold tables of so many bytes of text: one for each ``BYTES``, at least as many as a shuffle has.

    A bucket is read and sorted by one task, so its size must not grow with the table.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-size // BYTES), MOST))


def store(df: DataFrame, path: str, key: str, count: int | None = None) -> Bucketed:
    """Write a table in ``count`` buckets of an integer column, by default as many as a shuffle has partitions.

    One shuffle; each bucket is one file. ``df`` is read twice, once for its hot keys, so it should be a stored table.
    """
    spark = df.sparkSession
    count = count or int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(df, key, share=uneven_share(spark, count))[key]
    apart = F.col(key).isNull() | (F.col(key).isin(hot) if hot else F.lit(False))
    df.where(apart).write.mode("overwrite").parquet(f"{path}/apart")
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    placed = df.where(~apart).repartition(count, key)
    writer = placed.write.mode("overwrite").format("parquet").bucketBy(count, key).sortBy(key)
    writer.option("path", f"{path}/buckets").saveAsTable(_name(path))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    layout = {"key": key, "count": count, "hot": hot, "columns": ddl}
    paths.write_text(spark, f"{path}/_layout.json", json.dumps(layout))
    return load(spark, path)


def load(spark: SparkSession, path: str) -> Bucketed:
    """A stored table, whichever application wrote it."""
    layout = json.loads(paths.read_text(spark, f"{path}/_layout.json"))
    name, key = _name(path), layout["key"]
    if not spark.catalog.tableExists(name):
        spark.sql(
            f"CREATE TABLE {name} ({layout['columns']}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`)"
            f" INTO {layout['count']} BUCKETS LOCATION '{path}/buckets'"
        )
    apart = spark.read.schema(layout["columns"]).parquet(f"{path}/apart")
    return Bucketed(key, layout["count"], spark.table(name), apart, layout["hot"])
