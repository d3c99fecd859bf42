"""Finding keys that hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.shuffles import freed_at_end

#: What one key may weigh in the task it is placed in, in mean tasks.
UNEVEN = 2
#: A sketch tracks twenty values for each of this many shares, and Spark allows a million.
_MOST_SHARES = 50_000


def uneven_share(spark: SparkSession, tasks: int | None = None) -> float:
    """The share of all rows that ``UNEVEN`` of so many tasks hold on average, by default those of a shuffle.

    It follows the number of shuffle partitions: a key with a smaller share may be placed in one
    task at any size of data and cluster. Beyond 100,000 partitions it stays where it is there.
    """
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(1.0, max(UNEVEN / tasks, 1 / _MOST_SHARES))


def placing(df: DataFrame, key: str, user: str = "user_id") -> dict[str, bool]:
    """By which columns rows may be placed without filling a task: ``place_by_key`` and ``place_by_user``, from one scan."""
    hot = hot_keys(df, key, user, share=uneven_share(df.sparkSession))
    return {"place_by_key": not hot[key], "place_by_user": not hot[user]}


def hot_keys(df: DataFrame, *columns: str, share: float = 0.001) -> dict[str, list[int]]:
    """Per integer column, the values that hold more than ``share`` of its rows.

    One column-pruned scan fills a frequent-items sketch per column and task, and
    the sketches are merged in two steps, so nothing is shuffled by key. At most
    ``1 / share`` values can qualify, which bounds what reaches the driver. A
    sketch tracks twenty times as many, so its error is far below ``share`` and no
    hot value is missed; it may list one that is slightly less frequent.
    """
    most = int(1 / share)
    tracked = 20 * most
    part = F.pmod(F.spark_partition_id(), F.lit(1000)).alias("part")
    fill = [F.expr(f"approx_top_k_accumulate(`{c}`, {tracked}) AS `{c}`") for c in columns]
    merge = [F.expr(f"approx_top_k_combine(`{c}`, {tracked}) AS `{c}`") for c in columns]
    top = [F.expr(f"approx_top_k_estimate(`{c}`, {2 * most}) AS `{c}`") for c in columns]
    sketches = (
        df.select(*columns, part)
        .groupBy("part")
        .agg(*fill, F.count(F.lit(1)).alias("seen"))
        .groupBy(F.lit("all"))  # no row, and not an error, for an empty table
        .agg(*merge, F.sum("seen").alias("seen"))
        .select(*top, "seen")
    )
    with freed_at_end(df.sparkSession):
        row = sketches.first()
    if row is None:
        return {c: [] for c in columns}
    return {
        c: sorted(
            t["item"]
            for t in row[c] or ()
            if t["item"] is not None and t["count"] > max(1, share * row["seen"])
        )
        for c in columns
    }
