"""The six source files: presence check, landing as dated snapshots, scan.

Landing stores the lines of the files as they are. How a line divides into fields is
decided when the raw layer is read, so a wrong guess loses nothing.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from basketry.contracts import ENTITIES, Entity
from basketry.functions.together import together
from basketry.sources import paths
from basketry.sources.snapshots import (
    SnapshotSummary,
    latest_snapshot,
    snapshot_path,
    write_snapshot,
)

#: What a landed line comes with: its file, the byte at which its part of the file starts, and
#: numbers that grow with the lines of that part and are unique in a landing.
LINE_COLUMNS = ["line", "source_file", "block", "row"]
#: First lines of files, one row each, that the driver looks at; those of more files are joined by sorting.
BROADCAST_FILES = 100_000
#: Rows of first lines that are written out in a filter.
_LISTED = 1000
_HEADERS, _FIRST = "_headers", "source_file string, header string, block long, row long"


@dataclass(frozen=True)
class Dialect:
    """How quotes and line breaks inside quoted fields are written.

    With ``doubled_quotes`` a quote inside a field is doubled, else it has a backslash before it.
    With ``multi_line`` quoted fields may hold line breaks, else a record ends with its line.
    """

    doubled_quotes: bool = False
    multi_line: bool = False

    @property
    def escape(self) -> str:
        return '"' if self.doubled_quotes else "\\"


DEFAULT = Dialect()
RFC4180 = Dialect(doubled_quotes=True, multi_line=True)


def scan_csv(spark: SparkSession, path: str, dialect: Dialect = DEFAULT) -> DataFrame:
    """A CSV file, or a directory of parts, with a header and only string columns.

    Parts whose headers differ are an error and not read by place.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", dialect.escape)
        .option("multiLine", dialect.multi_line)
        .csv(path)
    )


def source_manifest(spark: SparkSession, source_dir: str) -> DataFrame:
    """Each expected source and whether it is there, as one file or a directory of parts."""
    there = set(paths.children(spark, source_dir))
    return spark.createDataFrame(
        [(e.name, e.file_name, e.file_name in there) for e in ENTITIES.values()],
        "entity string, file_name string, present boolean",
    )


def require_sources(spark: SparkSession, source_dir: str) -> None:
    """Fail with the names of all missing source files."""
    missing = [
        r.file_name
        for r in source_manifest(spark, source_dir).where(~F.col("present")).collect()
    ]
    if missing:
        raise FileNotFoundError(f"missing source files: {', '.join(sorted(missing))}")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a text file or directory, unchanged but for its line feed."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def land_lines(lines: DataFrame, root: str, label: str) -> SnapshotSummary:
    """A raw snapshot of lines, with the first line of each file beside it, where readers of lines don't see it."""
    summary = write_snapshot(lines, root, label)
    at = snapshot_path(root, label)
    stored = lines.sparkSession.read.schema(lines.schema).parquet(at)
    _first_lines(stored, DEFAULT).write.mode("overwrite").parquet(f"{at}/{_HEADERS}")
    return summary


def land_sources(
    spark: SparkSession, source_dir: str, raw_root: str, label: str
) -> list[SnapshotSummary]:
    """Copy the lines of the source files into raw snapshots, replacing a former load.

    They are stored as Parquet, which splits among tasks. The summaries count lines, headers and
    blank ones included.
    """
    require_sources(spark, source_dir)

    def land(entity: Entity) -> SnapshotSummary:
        lines = read_lines(spark, f"{source_dir}/{entity.file_name}")
        return land_lines(lines, f"{raw_root}/{entity.name}", label)

    return together(spark, [partial(land, e) for e in ENTITIES.values()])


def _open_after(dialect: Dialect) -> tuple[Column, Column]:
    """Whether a quoted field is open after a line, if none was before it, and if one was.

    A quote opens a field only where the field begins; elsewhere in an unquoted one it is text. The patterns
    never go back, so that lines of any length need no more stack.
    """
    inside = '[^"]*+(?:""[^"]*+)*+' if dialect.doubled_quotes else r'[^"\\]*+(?:\\(?:.|$)[^"\\]*+)*+'
    field = f'(?:"{inside}"[^,]*+|[^",][^,]*+)?'
    rest = f'(?:{field},)*+"{inside}$'
    line = F.col("line")
    return line.rlike(f"(?s)^{rest}"), line.rlike(f'(?s)^{inside}(?:$|"[^,]*+,{rest})')


def _joined(lines: DataFrame, dialect: Dialect) -> DataFrame:
    """Records as one row each, where quoted fields may hold line breaks.

    What a line does to the state of being inside a quoted field is one of four things: it closes, opens, keeps or flips
    it. These compose in any grouping, so each block of a file is summed up by itself, the sums (a row for each
    block) are put in order, and with the state at its start each block finds its records. Only the parts of
    records that cross the edge of a block are shuffled again.
    """
    block = ["source_file", "block"]
    from_none, from_open = _open_after(dialect)
    in_block = Window.partitionBy(*block).orderBy("row")
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    marked = lines.select(*LINE_COLUMNS, from_none.alias("sets_to"), from_open.alias("from_open")).select(
        *LINE_COLUMNS,
        F.when(F.col("sets_to") == F.col("from_open"), F.col("sets_to")).alias("sets_to"),
        (F.col("sets_to") & ~F.col("from_open")).cast("int").alias("flips"),
    )
    marked = marked.withColumn("turns", F.sum("flips").over(in_block))
    set_at = F.struct(F.col("sets_to").alias("to"), "turns")
    last = F.last(F.when(F.col("sets_to").isNotNull(), set_at), ignorenulls=True)
    marked = marked.withColumn("last", last.over(before)).select(
        *LINE_COLUMNS, "sets_to", "flips",
        F.col("last.to").alias("known"),  # the state before the line, but for `odd`; NULL: that of the block's start
        ((F.col("turns") - F.col("flips") - F.coalesce("last.turns", F.lit(0))) % 2 == 1).alias("odd"),
    )

    def starts(entry: bool) -> Column:
        return F.max(F.when(F.coalesce("known", F.lit(entry)) == F.col("odd"), F.col("row")))

    after = F.struct(
        F.coalesce("sets_to", "known").alias("known"),
        (F.col("sets_to").isNull() & (F.col("odd") != (F.col("flips") == 1))).alias("odd"),
    )
    edges = marked.groupBy(*block).agg(
        F.max_by(after, "row").alias("after"), starts(False).alias("last_start"), starts(True).alias("last_start_inside")
    )
    in_file = Window.partitionBy("source_file").orderBy("block")
    earlier = in_file.rowsBetween(Window.unboundedPreceding, -1)
    flips = (F.col("after.known").isNull() & F.col("after.odd")).cast("int")
    edges = edges.withColumn("flips", flips).withColumn("turns", F.sum("flips").over(in_file))
    set_at = F.struct((F.col("after.known") != F.col("after.odd")).alias("to"), "turns")
    last = F.last(F.when(F.col("after.known").isNotNull(), set_at), ignorenulls=True)
    edges = edges.withColumn("last", last.over(earlier))
    odd = (F.col("turns") - F.col("flips") - F.coalesce("last.turns", F.lit(0))) % 2 == 1
    edges = edges.withColumn("entry", F.coalesce("last.to", F.lit(False)) != odd)
    edges = edges.select(
        *block, "entry",
        (F.coalesce("after.known", "entry") != F.col("after.odd")).alias("exit"),
        F.when(F.col("entry"), F.col("last_start_inside")).otherwise(F.col("last_start")).alias("last_start"),
    )
    # In which block the record began that is open at the start of a block.
    opens = F.when(F.col("exit") & F.col("last_start").isNotNull(), F.col("block"))
    edges = edges.withColumn("home", F.last(opens, ignorenulls=True).over(earlier))

    began = F.coalesce("known", "entry") == F.col("odd")
    numbered = marked.join(edges, block).withColumn("record", F.count_if(began).over(in_block))
    parts = numbered.groupBy(*block, "record").agg(
        F.min("row").alias("row"),
        F.array_join(F.array_sort(F.collect_list(F.struct("row", "line")))["line"], "\n").alias("line"),
        *[F.first(c).alias(c) for c in ("exit", "last_start", "home")],
    )
    goes_on = F.col("exit") & (F.col("row") == F.col("last_start"))
    crosses = (F.col("record") == 0) | F.coalesce(goes_on, F.lit(False))
    home = F.when(F.col("record") == 0, F.col("home")).otherwise(F.col("block"))
    crossing = parts.where(crosses).select("line", "source_file", "block", "row", home.alias("home"))
    put_together = crossing.groupBy("source_file", "home").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("block", "line")))["line"], "\n").alias("line"),
        F.min_by("row", "block").alias("row"),
    )
    return parts.where(~crosses).select(*LINE_COLUMNS).unionByName(
        put_together.select("line", "source_file", F.col("home").alias("block"), "row")
    )


def _records(lines: DataFrame, dialect: Dialect) -> DataFrame:
    """Lines that are a record each; with ``multi_line`` those that a quoted break parts are joined."""
    lines = lines.withColumn("line", F.rtrim("line", F.lit("\r")))
    if dialect.multi_line:
        lines = _joined(lines, dialect)
    return lines.where(F.col("line").rlike(r"[^\x00-\x20]"))


def _names(header: str, dialect: Dialect) -> list[str]:
    escape = None if dialect.doubled_quotes else "\\"
    names = next(csv.reader([header], doublequote=dialect.doubled_quotes, escapechar=escape))
    lone = [n if n and names.count(n) == 1 else f"{n or '_c'}{i}" for i, n in enumerate(names)]
    return [n.strip() for n in lone]


def _first_lines(lines: DataFrame, dialect: Dialect) -> DataFrame:
    """(source_file, header, block, row): the first record of each file. Only first blocks are read for them.

    Their numbers are found first, which no line is held or sorted for, and then the lines of these numbers. Records of
    several lines are sorted to be put together anyway.
    """
    records = _records(lines.where("block = 0"), dialect)
    if dialect.multi_line:
        at = F.struct("block", "row")
        found = records.groupBy("source_file").agg(F.min_by("line", at).alias("header"), F.min(at).alias("at"))
        return found.select("source_file", "header", "at.*")
    first = records.groupBy("source_file").agg(F.min("row").alias("row"))
    known = first.limit(BROADCAST_FILES + 1).collect()
    if len(known) <= BROADCAST_FILES:
        first = F.broadcast(lines.sparkSession.createDataFrame(known, first.schema))
    if len(known) <= _LISTED:
        records = records.where(F.col("row").isin([r["row"] for r in known]))
    return records.join(first, ["source_file", "row"]).select("source_file", F.col("line").alias("header"), "block", "row")


def parse_lines(
    lines: DataFrame, dialect: Dialect = DEFAULT, first_lines: DataFrame | None = None
) -> DataFrame:
    """String columns named by the header of each file, and ``source_file``.

    Files with other headers are put together by name, NULL where a file lacks a column, all in one
    pass. Blank lines are left out, fields beyond the header are not read, missing ones are NULL.
    ``first_lines`` are those that ``land_lines`` has stored, if there are any.
    """
    spark = lines.sparkSession
    if first_lines is None or dialect.multi_line:
        first_lines = _first_lines(lines, dialect)
    records = _records(lines, dialect)
    known = first_lines.limit(BROADCAST_FILES + 1).collect()
    if not known:  # no file with a line: no column but the file's
        return records.select("source_file")
    headers = {r["header"] for r in known}
    if len(known) <= BROADCAST_FILES:
        first_lines = F.broadcast(spark.createDataFrame(known, first_lines.schema))
    else:
        headers |= {r["header"] for r in first_lines.select("header").distinct().collect()}
    if len(headers) == 1 and len(known) <= _LISTED:
        body = records.where(~((F.col("block") == 0) & F.col("row").isin([r["row"] for r in known])))
    else:
        first = first_lines.select("source_file", "header", F.col("block").alias("at"), F.col("row").alias("first"))
        body = records.join(first, "source_file").where((F.col("block") != F.col("at")) | (F.col("row") != F.col("first")))
    schemas = {h: StructType([StructField(n, StringType()) for n in _names(h, dialect)]) for h in sorted(headers)}
    names = list(dict.fromkeys(n for schema in schemas.values() for n in schema.names))
    fields = F.lit(None)
    for header, schema in schemas.items():
        own = F.from_csv("line", schema.toDDL(), {"escape": dialect.escape})
        if schema.names != names:  # bound to a name, so that a line is parsed once
            every = [(lambda f, n: f[n] if n in schema.names else F.lit(None).cast("string"), n) for n in names]
            own = F.transform(F.array(own), lambda f: F.struct(*[pick(f, n).alias(n) for pick, n in every]))[0]
        fields = own if len(schemas) == 1 else F.when(F.col("header") == header, own).otherwise(fields)
    return body.select(fields.alias("fields"), "source_file").select("fields.*", "source_file")


def _listing(spark: SparkSession, path: str) -> DataFrame:
    # Only path and length are read, so Spark never opens the files.
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def landing_summary(spark: SparkSession, raw_root: str, label: str) -> DataFrame:
    """Number and total size of the files landed per entity."""
    per_entity = [
        _listing(spark, snapshot_path(f"{raw_root}/{name}", label)).agg(
            F.lit(name).alias("entity"),
            F.count(F.lit(1)).alias("files"),
            F.sum("length").alias("bytes"),
        )
        for name in ENTITIES
    ]
    out = per_entity[0]
    for df in per_entity[1:]:
        out = out.unionByName(df)
    return out


def landed_lines(
    spark: SparkSession, raw_root: str, entity: str, label: str | None = None
) -> tuple[DataFrame, str]:
    """The lines of a raw snapshot as they were landed, by default the latest, and its label."""
    root = f"{raw_root}/{entity}"
    label = label or latest_snapshot(spark, root)
    return spark.read.parquet(snapshot_path(root, label)).select(*LINE_COLUMNS), label


def scan_raw(
    spark: SparkSession,
    raw_root: str,
    entity: str,
    label: str | None = None,
    dialect: Dialect = DEFAULT,
) -> tuple[DataFrame, str]:
    """All columns of a raw snapshot and ``source_file``, by default the latest, and its label.

    Takes snapshots landed by ``land_sources`` and directories that hold the CSV
    file itself.
    """
    root = f"{raw_root}/{entity}"
    label = label or latest_snapshot(spark, root)
    at = snapshot_path(root, label)
    csv_file = f"{at}/{ENTITIES[entity].file_name}"
    if paths.exists(spark, csv_file):
        scan = scan_csv(spark, csv_file, dialect)
        return scan.withColumn("source_file", F.col("_metadata.file_path")), label
    if paths.exists(spark, at) and paths.has_data_files(spark, at):
        stored = f"{at}/{_HEADERS}"
        first_lines = spark.read.schema(_FIRST).parquet(stored) if paths.exists(spark, stored) else None
        return parse_lines(landed_lines(spark, raw_root, entity, label)[0], dialect, first_lines), label
    raise FileNotFoundError(f"no data files in {at}")


def read_raw(
    spark: SparkSession,
    raw_root: str,
    entity: str,
    label: str | None = None,
    dialect: Dialect = DEFAULT,
) -> tuple[DataFrame, str]:
    """The expected columns of a raw snapshot plus ``source_file_name``, and its label.

    Columns are found by name; a missing one is an error.
    """
    scan, label = scan_raw(spark, raw_root, entity, label, dialect)
    return (
        scan.select(*ENTITIES[entity].columns, F.col("source_file").alias("source_file_name")),
        label,
    )
