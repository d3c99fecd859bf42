"""Helpers that the operators share: reading a table, cutting lineage, keys of texts."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from basketry.sources import paths


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str = "cut", compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it again: the lineage ends there.

    A lost executor costs only the tasks it ran, since every later stage starts from files that all
    executors see.
    """
    folder = paths.work_folder(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", compression).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def columns(docs: DataFrame, **named: str) -> DataFrame:
    """Only the columns an operator works on, under its own names.

    Further columns of the input, whatever they are called, can then not clash with the operator's.
    """
    return docs.select(*[docs[column].alias(name) for name, column in named.items()])


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once per application; Spark sends it from the driver."""
    package, context = Path(__file__).parents[1], spark.sparkContext
    if not package.is_dir() or getattr(context, "_shipped", False):
        return  # read from an archive that they already have, or sent before
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._shipped = True


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str | StructType
) -> DataFrame:
    """``function`` applied to each Arrow batch by itself."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return map_partitions(df, apply, schema)


def map_partitions(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``function`` applied to the Arrow batches of each partition."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """A batch cut into parts whose values of ``column`` have about ``limit`` bytes, one row at least.

    What a worker builds from a part is then bounded by the limit or by one long text, however many
    rows the batch has.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // limit
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for start, end in pairwise(starts):
        if end > start:
            yield batch.slice(start, end - start)


def texts_as_bytes(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    return batch.column(column).cast(pa.binary()).to_pylist()
