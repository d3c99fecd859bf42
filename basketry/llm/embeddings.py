"""Embedding near-duplicates: random-hyperplane signs in several tables, exact cosine, components.

In each table the signs of a vector's products with random planes are its bucket. A pair at the
threshold agrees on one sign with probability 1 - angle/pi, from which the number of tables follows for a
wanted recall; vectors in one bucket and label are compared by their exact cosine.

Equal vectors are one node with a count. A bucket that holds more than ``BLOCK`` nodes is divided into
blocks, and every two blocks of it meet in a task of their own, so that no group is collected whole. A
pair that meets in several tables counts in the first. Each meeting returns the number of links of every
vector and only as many edges as connect them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import components
from basketry.llm.tables import columns, cut, map_partitions

THRESHOLD, RECALL = 0.93, 0.995
#: Nodes of one bucket that meet in one task at most, against as many others.
BLOCK = 2048
SEED = 20
_NODE = "node long, label string, size long, vector array<double>, signs array<long>"


def shape(nodes: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Signs in a table and number of tables: as many buckets as nodes, and the recall at the threshold."""
    signs = min(48, max(8, math.ceil(math.log2(max(nodes, 2)))))
    agree = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def _unit(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, vector): usable vectors only, as doubles of length 1."""
    rows = columns(vectors, vec_id=vec_id, label=label, embedding=embedding).select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    most = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    usable = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull()).where(finite)
    # Divided by the largest component first, so that squares neither overflow nor vanish.
    scaled = usable.withColumn("most", most).where("most > 0").withColumn(
        "v", F.transform("v", lambda x: x / F.col("most"))
    )
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return scaled.withColumn("norm", norm).select(
        "vec_id", "label", F.transform("v", lambda x: x / F.col("norm")).alias("vector")
    )


def _signed(nodes: DataFrame, signs: int, tables: int) -> DataFrame:
    """``nodes`` with their bucket in each table."""

    def planes(width: int) -> np.ndarray:
        return np.random.default_rng([SEED, width]).standard_normal((width, signs * tables))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(signs, dtype=np.int64)
        for batch in batches:
            found = []
            for v in batch.column("vector").to_pylist():
                if len(v) not in drawn:
                    drawn[len(v)] = planes(len(v))
                positive = (np.array(v) @ drawn[len(v)] > 0).reshape(tables, signs)
                found.append(positive @ weights)
            out = pa.array([f.tolist() for f in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, "signs"])

    return map_partitions(nodes, apply, _NODE)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the given edges."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        if (rx := find(x)) != (ry := find(y)):
            parent[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


def _meet(table: int, same: bool, first: dict, second: dict, threshold: float) -> tuple[tuple, list]:
    """Links of one block with another: nodes with how many, weighted by copies, and edges."""
    close = first["vector"] @ second["vector"].T >= threshold
    if same:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    # A pair belongs to the first table in which it meets.
    earlier = (first["signs"][i, :table] == second["signs"][j, :table]).any(axis=1)
    i, j = i[~earlier], j[~earlier]
    a, b = first["node"][i], second["node"][j]
    ends, weight = np.concatenate([a, b]), np.concatenate([second["size"][j], first["size"][i]])
    nodes, at = np.unique(ends, return_inverse=True)
    return (nodes, np.bincount(at, weight, len(nodes)).astype(np.int64)), _forest(a, b)


def _lists(column: pa.ListArray, rows: np.ndarray) -> np.ndarray:
    """Rows of a list column, all of one length, as a matrix."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy()
    width = offsets[rows[0] + 1] - offsets[rows[0]]
    return values[offsets[rows][:, None] + np.arange(width)]


def _meetings(threshold: float):
    """Rows sorted by meeting to (a, b, links): b NULL with a's number of links, or an edge a-b."""
    keys = ["table", "label", "sign", "left", "right"]

    def one(batch: pa.RecordBatch, begin: int, end: int, found: list[list]) -> None:
        table, left, right = (batch.column(c)[begin].as_py() for c in ("table", "left", "right"))
        side = batch.column("side").to_numpy()[begin:end]
        widths = np.diff(batch.column("vector").offsets.to_numpy())[begin:end]
        for width in np.unique(widths):
            sides = []
            for own in {left: 0, right: 0}:
                rows = begin + np.flatnonzero((side == own) & (widths == width))
                if len(rows):
                    sides.append({
                        "vector": _lists(batch.column("vector"), rows), "signs": _lists(batch.column("signs"), rows),
                        **{c: batch.column(c).to_numpy()[rows] for c in ("node", "size")},
                    })
            if len(sides) == 1 + (left != right):
                (nodes, links), edges = _meet(table, left == right, sides[0], sides[-1], threshold)
                found[0] += [*nodes.tolist(), *(x for x, _ in edges)]
                found[1] += [None] * len(nodes) + [y for _, y in edges]
                found[2] += [*links.tolist(), *[0] * len(edges)]

    def settled(batch: pa.RecordBatch, ends: list[int]) -> Iterator[pa.RecordBatch]:
        found: list[list] = [[], [], []]
        for begin, end in zip([0, *ends], ends, strict=False):
            if end - begin > 1:
                one(batch, begin, end, found)
        if found[0]:
            arrays = [pa.array(x, pa.int64()) for x in found]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "links"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last meeting, which may go on in the next batch
        for new in batches:
            batch = pa.concat_batches([held, new]) if held is not None else new
            changes = np.zeros(max(batch.num_rows - 1, 0), bool)
            for c in keys:
                column = batch.column(c)
                numbers = column.dictionary_encode().indices if c == "label" else column
                changes |= np.diff(numbers.to_numpy()) != 0
            ends = (np.flatnonzero(changes) + 1).tolist()
            yield from settled(batch, ends)
            last = ends[-1] if ends else 0
            held = pa.concat_batches([batch.slice(last)])
        if held is not None:
            yield from settled(held, [held.num_rows])

    return apply


def links(nodes: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(a, b, links) rows for nodes (node, label, size, vector): counts where b is NULL, else edges."""
    signs, tables = shape(nodes.count(), threshold, recall)
    signed = cut(_signed(nodes, signs, tables), "signed")
    met = signed.select("node", "label", F.posexplode("signs").alias("table", "sign"))
    sizes = met.groupBy("table", "label", "sign").count().where("count > 1")
    sizes = cut(sizes.withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int")), "buckets")
    sides = met.join(sizes, ["table", "label", "sign"]).withColumn(
        "side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    met = sides.select("node", "table", "label", "sign", "side", others).select(
        "node", "table", "label", "sign", "side",
        F.least("side", "other").alias("left"), F.greatest("side", "other").alias("right"),
    )
    full = met.join(signed.select("node", "size", "vector", "signs"), "node")
    keys = ["table", "label", "sign", "left", "right"]
    dealt = full.repartition(*keys).sortWithinPartitions(*keys)
    return map_partitions(dealt, _meetings(threshold), "a long, b long, links long")


def near_duplicates(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Vectors are compared within a label. Those that are NULL, zero or hold a NULL or non-finite number, or
    have no label, have no links. Rows that repeat a vec_id are one vector, the smallest by label and
    numbers; each gets the same result. A row with a NULL vec_id takes no part and has component_id NULL.
    """
    rows = columns(vectors, vec_id=vec_id).select(F.col("vec_id").cast("long"))
    usable = _unit(vectors, vec_id, embedding, label).where("vec_id is not null")
    usable = usable.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("own"))
    usable = cut(usable.select("vec_id", "own.*"), "unit")
    key = F.sha2(F.concat_ws("|", "label", F.col("vector").cast("string")), 256)
    keyed = usable.select("vec_id", key.alias("key"))
    groups = keyed.groupBy("key").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("size"))
    groups = cut(groups, "groups")
    nodes = usable.join(groups.select(F.col("node").alias("vec_id"), "size"), "vec_id")
    nodes = nodes.select(F.col("vec_id").alias("node"), "label", "size", "vector")
    found = cut(links(nodes, threshold, recall), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null"))
    classes = (
        groups.join(counts, "node", "left")
        .join(roots, "node", "left")
        .select("key", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    )
    of_ids = keyed.join(cut(classes, "classes"), "key").select("vec_id", "root", "n_links")
    return rows.join(cut(of_ids, "ids"), "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("root", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("root", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
