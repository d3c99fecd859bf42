"""Quality checks as Spark jobs. Each returns a report; ``require`` turns it into an error.

A report has one row per check: table_name, check_name, expected, observed, passed.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from basketry.contracts import ENTITIES, contract
from basketry.functions.columns import lenient_cast
from basketry.functions.together import together
from basketry.sources.raw import DEFAULT, Dialect, read_lines, scan_raw
from basketry.sources.snapshots import read_snapshot

# Columns that identify a row of each table, and references from items and products.
TABLE_KEYS = {
    "orders": ["order_id"],
    "products": ["product_id"],
    "aisles": ["aisle_id"],
    "departments": ["department_id"],
    "order_products_prior": ["order_id", "product_id"],
    "order_products_train": ["order_id", "product_id"],
}
REFERENCES = [
    ("order_products_prior", "order_id", "orders"),
    ("order_products_train", "order_id", "orders"),
    ("order_products_prior", "product_id", "products"),
    ("order_products_train", "product_id", "products"),
    ("products", "aisle_id", "aisles"),
    ("products", "department_id", "departments"),
]


def _check(table: str, name: str, expected: str, observed: Column | str, passed: Column | bool):
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(name).alias("check_name"),
        F.lit(expected).alias("expected"),
        (F.lit(observed) if isinstance(observed, str) else observed).alias("observed"),
        (F.lit(passed) if isinstance(passed, bool) else passed).alias("passed"),
    )


def contract_report(df: DataFrame, layer: str, table: str) -> DataFrame:
    """Columns against the contract, by name and in any order, their types and the row count.

    Missing columns, other types and an empty table fail. Unexpected columns are only listed.
    ``df`` is the table as it was stored, with all its columns. Reading it whole costs no more than
    its row count.
    """
    expected = {f.name: f.dataType.simpleString() for f in contract(layer, table)}
    found = dict(df.dtypes)
    missing = sorted(expected.keys() - found.keys())
    unexpected = sorted(found.keys() - expected.keys() - {"source_file"})
    retyped = sorted(
        f"{n} {found[n]}" for n, kind in expected.items() if n in found and found[n] != kind
    )
    name = f"{layer}.{table}"
    rows = F.col("rows")
    checks = F.array(
        _check(name, "missing_columns", "", ",".join(missing), not missing),
        _check(name, "unexpected_columns", "", ",".join(unexpected), True),
        _check(name, "wrong_types", "", ",".join(retyped), not retyped),
        _check(name, "row_count", "> 0", rows.cast("string"), rows > 0),
    )
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(checks))


def union_reports(reports: list[DataFrame]) -> DataFrame:
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def raw_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``contract_report`` for all six raw tables; one that fails hides no other."""
    return union_reports([contract_report(tables[e], "raw", e) for e in ENTITIES])


def require(report: DataFrame) -> None:
    """Raise with every failed check of a report."""
    failed = report.where(~F.col("passed")).collect()
    if failed:
        lines = [f"{r.table_name}: {r.check_name} is '{r.observed}'" for r in failed]
        raise ValueError("quality checks failed:\n" + "\n".join(lines))


def _settled(report: DataFrame) -> DataFrame:
    """The rows of a report, computed once; it is small."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def validate_snapshot(spark: SparkSession, layer_root: str, layer: str, table: str) -> DataFrame:
    """Check the latest snapshot of a bronze, silver or gold table; return its report.

    Raises if there is no snapshot, the newest has no files, or a check fails.
    """
    report = contract_report(read_snapshot(spark, f"{layer_root}/{table}"), layer, table)
    report = _settled(report)
    require(report)
    return report


def validate_raw(spark: SparkSession, raw_root: str, dialect: Dialect = DEFAULT) -> DataFrame:
    """Check the latest raw snapshot of all six entities; fail once, naming all problems."""

    def check(entity: str) -> DataFrame | str:
        try:
            raw, _ = scan_raw(spark, raw_root, entity, dialect=dialect)
            report = _settled(contract_report(raw, "raw", entity))
            require(report)
            return report
        except (FileNotFoundError, ValueError, PySparkException) as problem:
            return f"{entity}: {problem}"

    found = together(spark, [partial(check, e) for e in ENTITIES])
    problems = [x for x in found if isinstance(x, str)]
    if problems:
        raise ValueError("raw validation failed:\n" + "\n".join(problems))
    return union_reports(found)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Each key that occurs more than once, with its row count. Keys with a NULL are left out."""
    return (
        df.dropna("any", subset=keys)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def key_duplicates(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: how many keys repeat and how many rows are too many."""
    counts = [
        duplicate_keys(bronze[table], keys).agg(
            F.lit(table).alias("table_name"),
            F.lit(",".join(keys)).alias("key_columns"),
            F.count(F.lit(1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("surplus_rows"),
        )
        for table, keys in TABLE_KEYS.items()
    ]
    return union_reports(counts)


def type_conformance(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Per numeric column: raw values that are not NULL but become NULL in bronze."""
    counts = []
    for table, spec in ENTITIES.items():
        numeric = [
            f for f in spec.schema if isinstance(f.dataType, IntegerType | DoubleType)
        ]
        bad = [
            F.count_if(
                F.col(f.name).isNotNull()
                & lenient_cast(F.trim(F.col(f.name)), f.dataType).isNull()
            ).alias(f.name)
            for f in numeric
        ]
        per_column = F.array(
            *(
                F.struct(
                    F.lit(table).alias("table_name"),
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("expected_type"),
                    F.col(f.name).alias("bad_values"),
                )
                for f in numeric
            )
        )
        counts.append(raw[table].agg(*bad).select(F.inline(per_column)))
    return union_reports(counts)


def source_records(spark: SparkSession, path: str) -> DataFrame:
    """One row: the records of a source, found without a CSV parser.

    They are the lines that are not blank, less one header for each file. Files whose fields hold
    line breaks have fewer records than that.
    """
    lines = read_lines(spark, path).where(F.col("line").rlike(r"[^\x00-\x20]"))
    per_file = lines.groupBy("source_file").agg((F.count(F.lit(1)) - 1).alias("n"))
    return per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("source_rows"))


def source_raw_counts(
    source: Mapping[str, DataFrame], landed: Mapping[str, DataFrame]
) -> DataFrame:
    """Per entity: records of the source, rows landed, and whether they agree.

    ``source`` has a row ``source_rows`` for each entity, as ``source_records`` gives; ``landed`` has
    the rows that are read from the raw layer.
    """
    counts = []
    for entity in ENTITIES:
        rows = landed[entity].agg(F.count(F.lit(1)).alias("raw_rows")).scalar()
        counts.append(
            source[entity]
            .select(F.lit(entity).alias("entity"), "source_rows", rows.alias("raw_rows"))
            .withColumn("passed", F.col("source_rows") == F.col("raw_rows"))
        )
    return union_reports(counts)


def _digests(lines: DataFrame, side: str) -> DataFrame:
    """Per file: lines and an order-free digest of them, the sum of their hashes, repeats included."""
    name = F.substring_index("source_file", "/", -1).alias("file")
    return lines.groupBy(name).agg(
        F.count(F.lit(1)).alias(f"{side}_lines"),
        F.sum(F.xxhash64("line").cast("decimal(38,0)")).alias(f"{side}_digest"),
    )


def content_differences(source: DataFrame, landed: DataFrame) -> DataFrame:
    """Where the lines of a source and of its landing differ: file, side, block and how many lines.

    Both have the columns of ``read_lines``. ``side`` is ``source`` for lines that the landing lacks or has fewer of, ``raw``
    for those that the source lacks; ``block`` is the byte at which the side's own part of the file starts, so it does
    not matter whether both were read in equal parts. Repeats count, the order of lines does not. Files whose
    digests agree are not looked at again, so that in general nothing but their digests is shuffled.
    """
    sides = {"source": source, "raw": landed}
    digests = _digests(source, "source").join(_digests(landed, "raw"), "file", "full")
    same = F.col("source_lines").eqNullSafe(F.col("raw_lines")) & F.col("source_digest").eqNullSafe(F.col("raw_digest"))
    suspect = digests.where(~same).select("file")
    hashed = {
        side: lines.select(
            F.substring_index("source_file", "/", -1).alias("file"), "block", F.xxhash64("line").alias("hash")
        ).join(suspect, "file", "left_semi")
        for side, lines in sides.items()
    }
    signed = hashed["source"].select("file", "hash", F.lit(1).alias("n")).unionByName(
        hashed["raw"].select("file", "hash", F.lit(-1).alias("n"))
    )
    surplus = signed.groupBy("file", "hash").agg(F.sum("n").alias("n")).where("n <> 0")
    found = []
    for side, lines in hashed.items():
        more = surplus.where("n > 0" if side == "source" else "n < 0").select("file", "hash", F.abs("n").alias("n"))
        # Which of several equal lines is missing nobody can tell; the last blocks' are taken for it.
        counted = lines.join(more, ["file", "hash"]).groupBy("file", "hash", "block").agg(
            F.count(F.lit(1)).alias("here"), F.first("n").alias("n")
        )
        after = Window.partitionBy("file", "hash").orderBy(F.desc("block"))
        left = F.col("n") - (F.sum("here").over(after) - F.col("here"))
        lines_of = F.greatest(F.least("here", left), F.lit(0))
        found.append(
            counted.withColumn("lines", lines_of)
            .groupBy("file", F.lit(side).alias("side"), "block")
            .agg(F.sum("lines").alias("lines"))
            .where("lines > 0")
        )
    return found[0].unionByName(found[1])


def content_report(source: Mapping[str, DataFrame], landed: Mapping[str, DataFrame]) -> DataFrame:
    """Per entity: lines that only one side has, the files and blocks with such lines, and whether there are none."""
    reports, ends = [], [f"{which}_{side}" for side in ("source", "raw") for which in ("first", "last")]
    for entity in source:
        differing = content_differences(source[entity], landed[entity])
        only = [
            F.coalesce(F.sum(F.when(F.col("side") == side, F.col("lines"))), F.lit(0)).alias(f"only_in_{side}")
            for side in ("source", "raw")
        ]
        named = F.concat_ws(":", "side", "file", F.col("block").cast("string"))
        reports.append(
            differing.agg(
                F.lit(entity).alias("entity"),
                *only,
                F.count_distinct("file").alias("differing_files"),
                *[
                    reduction(F.when(F.col("side") == side, named)).alias(f"{which}_{side}")
                    for side in ("source", "raw")
                    for which, reduction in (("first", F.min), ("last", F.max))
                ],
            )
            # The first and the last block of either side, as texts go.
            .withColumn("differing_blocks", F.array_distinct(F.array_sort(F.array_compact(F.array(*ends)))))
            .withColumn("passed", (F.col("only_in_source") == 0) & (F.col("only_in_raw") == 0))
            .drop(*ends)
        )
    return union_reports(reports)


def orphans(bronze: Mapping[str, DataFrame]) -> DataFrame:
    """Per reference: ids that the referenced table lacks, and the rows that use them.

    Both sides are reduced to one row per id before the join, so a hot id or a
    referenced row with many copies weighs no more than any other.
    """
    counts = []
    for table, column, referenced in REFERENCES:
        used = (
            bronze[table]
            .where(F.col(column).isNotNull())
            .groupBy(column)
            .agg(F.count(F.lit(1)).alias("row_count"))
        )
        counts.append(
            used.join(bronze[referenced].select(column).distinct(), column, "left_anti").agg(
                F.lit(table).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(referenced).alias("referenced_table"),
                F.count(F.lit(1)).alias("orphan_ids"),
                F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows"),
            )
        )
    return union_reports(counts)


def save_report(report: DataFrame, path: str, label: str) -> None:
    """Append a report to the stored ones, under the label of the run."""
    report.withColumn("run_label", F.lit(label)).write.mode("append").parquet(path)
