"""Bronze: the raw strings, trimmed and typed, with lineage columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.contracts import ENTITIES
from basketry.functions.columns import lenient_cast, processed_at


def to_bronze(
    raw: DataFrame, entity: str, ingestion_date: str, batch_time: datetime | None = None
) -> DataFrame:
    """Type one raw table.

    Rows with a NULL in every column are dropped. A row of blanks or junk stays,
    with NULL where a value could not be read. ``source_file_name`` is taken from
    the input when the scan added it.
    """
    spec = ENTITIES[entity]
    source_file = (
        F.col("source_file_name") if "source_file_name" in raw.columns else F.lit("")
    )
    typed = [
        lenient_cast(F.trim(F.col(f.name)), f.dataType).alias(f.name) for f in spec.schema
    ]
    return raw.dropna("all", subset=spec.columns).select(
        *typed,
        source_file.alias("source_file_name"),
        F.lit(ingestion_date).alias("raw_ingestion_date"),
        processed_at(batch_time).alias("bronze_processed_at"),
    )
