"""Exact global ranks without putting all values in order in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranges(df: DataFrame, value: str, parts: int) -> list[float]:
    """At most ``parts`` - 1 values that cut the rows into stretches of about equal size."""
    shares = [i / parts for i in range(1, parts)]
    return sorted(set(df.approxQuantile(value, shares, 0.2 / parts))) if shares else []


def weight_before(histogram: DataFrame, value: str, weight: str, parts: int | None = None) -> DataFrame:
    """A histogram with ``before``: the whole weight of all smaller values, exact.

    ``histogram`` has one row for each number in column ``value``. Sketched quantiles cut the values into as many ranges as a
    shuffle has partitions; they decide only which range a row is in, never its rank. The ranges' weights, that many
    numbers, are summed up on the driver, and each range is put in order by itself. Rows without a value are
    left out.
    """
    spark = histogram.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = histogram.where(F.col(value).isNotNull())
    bounds = F.array(*[F.lit(b) for b in ranges(known, value, parts)])
    ranged = known.withColumn("range", F.size(F.filter(bounds, lambda b: b <= F.col(value))))
    sums = {r["range"]: r["sum"] for r in ranged.groupBy("range").agg(F.sum(weight).alias("sum")).collect()}
    offsets, so_far = [], 0
    for i in range(max(sums, default=0) + 1):
        offsets.append(so_far)
        so_far += sums.get(i, 0)
    inside = Window.partitionBy("range").orderBy(value)
    offset = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("range") + 1)
    return ranged.withColumn("before", offset + F.sum(weight).over(inside) - F.col(weight)).drop("range")
