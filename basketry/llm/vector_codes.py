"""Vector code compression: one codebook for each part of the vectors, trained by Lloyd's rounds on cover trees.

Vectors become integers and are cut into ``PARTS`` equal parts. Every ``BLOCK`` rows of a partition get one cover tree
for each part position, over their different parts. A node of a tree stands on a point; its radius is the
greatest distance to a point below it. Its children stand on points below it, the first one on the same point; each of
the points belongs to the first child that is within half of the next power of two, so that children are further than that
from one another. A node also holds the sum and the number of the parts below it.

In a round a tree is gone through from the top, all nodes of a step at once. If the nearest entry of the codebook is
nearer to a node's point than any other entry by more than twice the radius, the triangle inequality gives the
whole subtree to it, and the node's sum and number count for it. Only the children of ambiguous nodes go on, with
the entries that are still possible, down to single points, which are compared exactly in integers.

Trees are built once and written; each round reads them, and returns a sum and a count for each part position
and entry, added up by Spark. What the driver gets are codebooks: ``PARTS`` x ``ENTRIES`` short vectors.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.tables import columns, cut, map_batches

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows of one set of trees.
BLOCK = 4096
#: Integers beyond are set to it, so that distances and the sums of 10^9 rows are exact in 64 bits.
LARGEST = 1 << 24
#: Labels whose sums are sent to all executors; of more labels they are joined by sorting.
BROADCAST_LABELS = 100_000


@dataclass
class CoverTree:
    """Nodes step by step from the top: a node stands before its children, which are next to one another."""

    point: np.ndarray
    radius: np.ndarray
    total: np.ndarray  # of the parts below, repeats included
    count: np.ndarray
    parent: np.ndarray
    children: np.ndarray  # first and end
    leaf: np.ndarray  # for each row the node that is its point alone

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self))
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        with np.load(io.BytesIO(data)) as arrays:
            return cls(**arrays)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = (a - b).astype(float)
    return np.sqrt((gap * gap).sum(1))


def build(rows: np.ndarray) -> CoverTree:
    """A cover tree over integer points, repeated or not; no rows give no nodes."""
    points, of, times = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    center = np.zeros(min(len(points), 1), np.int64)  # the points that the nodes of a step stand on
    parent, base = np.full(len(center), -1), 0
    member, owner = np.arange(len(points)), np.zeros(len(points), np.int64)  # points below them, and whose
    steps, leaf = [], np.empty(len(points), np.int64)
    while len(center):
        reach = np.zeros(len(center))
        np.maximum.at(reach, owner, _apart(points[center][owner], points[member]))
        alone = reach[owner] == 0
        leaf[member[alone]] = base + owner[alone]
        member, owner = member[~alone], owner[~alone]
        cover = np.exp2(np.ceil(np.log2(np.maximum(reach, 1))) - 1)
        # All nodes make a child at a time, on their first point that no child covers yet.
        child, left, made = np.empty(len(member), np.int64), np.arange(len(member)), 0
        on, node, at = [], [], center.copy()
        active = np.flatnonzero(reach > 0)
        while len(active):
            number = np.zeros(len(center), np.int64)
            number[active] = made + np.arange(len(active))
            on.append(at[active])
            node.append(active)
            made += len(active)
            whose = owner[left]
            near = _apart(points[at[whose]], points[member[left]]) <= cover[whose]
            child[left[near]] = number[whose[near]]
            left = left[~near]
            active, first = np.unique(owner[left], return_index=True)
            at[active] = member[left[first]]
        node = np.concatenate([np.empty(0, np.int64), *node])
        by_node = np.argsort(node, kind="stable")
        rank = np.empty(made, np.int64)
        rank[by_node] = np.arange(made)
        ends = base + len(center) + np.cumsum(np.bincount(node, minlength=len(center)))
        starts = np.concatenate([[base + len(center)], ends[:-1]])
        steps.append((center, reach, parent, np.stack([starts, ends], 1)))
        parent = base + node[by_node]
        base += len(center)
        center, owner = np.concatenate([np.empty(0, np.int64), *on])[by_node], rank[child]
    if not steps:
        empty = np.empty(0, np.int64)
        return CoverTree(rows[:0], np.empty(0), rows[:0], empty, empty, np.empty((0, 2), np.int64), empty)
    center, radius, parent, children = (np.concatenate(x) for x in zip(*steps, strict=True))
    total, count = np.zeros((base, rows.shape[1]), np.int64), np.zeros(base, np.int64)
    total[leaf], count[leaf] = points * times[:, None], times
    end = base
    for step in steps[:0:-1]:  # from the lowest one up
        start = end - len(step[0])
        np.add.at(total, parent[start:end], total[start:end])
        np.add.at(count, parent[start:end], count[start:end])
        end = start
    return CoverTree(points[center], radius, total, count, parent, children, leaf[of.ravel()])


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all entries, in integers."""
    return (points * points).sum(1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(1)


def assign(tree: CoverTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes whose whole subtree has one nearest entry (the lowest of equally near ones), and that entry.

    Every part is below one of the nodes.
    """
    at = np.arange(min(len(tree.point), 1))
    possible = np.ones((len(at), len(entries)), bool)
    nodes, chosen = [at[:0]], [at[:0]]
    while len(at):
        far = np.where(possible, squares(tree.point[at], entries), np.iinfo(np.int64).max)
        best = far.argmin(1)
        away, radius = np.sqrt(far.astype(float)), tree.radius[at]
        nearest = away[np.arange(len(at)), best]
        # What rounding may add lets a node go on, never the other way round.
        limit = (nearest + 2 * radius) * (1 + 1e-9) + 1e-6
        possible &= away <= limit[:, None]
        sure = (radius == 0) | (possible.sum(1) == 1)
        nodes.append(at[sure])
        chosen.append(best[sure])
        first, end = tree.children[at[~sure]].T
        many = end - first
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        possible = np.repeat(possible[~sure], many, 0)
    return np.concatenate(nodes), np.concatenate(chosen)


def gather(tree: CoverTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sum and the number of the parts that are nearest to each entry."""
    nodes, chosen = assign(tree, entries)
    total, count = np.zeros(entries.shape, np.int64), np.zeros(len(entries), np.int64)
    np.add.at(total, chosen, tree.total[nodes])
    np.add.at(count, chosen, tree.count[nodes])
    return total, count


def code(tree: CoverTree, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row and the squared distance to it."""
    nodes, chosen = assign(tree, entries)
    found = np.full(len(tree.point), -1)
    found[nodes] = chosen
    while len(open_ := np.flatnonzero((found < 0) & (found[tree.parent] >= 0) & (tree.parent >= 0))):
        found[open_] = found[tree.parent[open_]]
    of_leaf = found[tree.leaf]
    gap = tree.point[tree.leaf] - entries[of_leaf]
    return of_leaf, (gap * gap).sum(1)


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(vectors.astype(float) * SCALE), -LARGEST, LARGEST).astype(np.int64)


def _usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    rows = columns(vectors, vec_id=vec_id, label=label, vector=embedding).select(
        F.col("vec_id").cast("long"), F.col("label").cast("string"), F.col("vector").cast("array<double>")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("vector").isNotNull() & finite & (F.size("vector") % PARTS == 0))


def compress(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> tuple[DataFrame, np.ndarray]:
    """One row per usable row: vec_id, label (as text), codes (array of ``PARTS`` numbers), error and
    label_error; and the codebooks, by part, entry and place in the part.

    Dropped are vectors that are NULL or hold NULL or components that aren't finite, that don't divide into
    ``PARTS``, or that have another length than the usable vector of the smallest vec_id. A NULL vec_id comes
    after all others. Codebooks begin with the rows of the ``ENTRIES`` smallest vec_ids (of equal ids the
    smallest vectors), or of all if there are fewer. ``label_error`` is NULL if the sum doesn't fit into a long.
    Empty vectors have code 0 and error 0 everywhere; no rows give no rows.
    """
    rows = _usable(vectors, vec_id, embedding, label)
    order = [F.col("vec_id").asc_nulls_last(), "vector"]
    length = next((len(r["vector"]) for r in rows.orderBy(*order).limit(1).collect()), 0)
    width = length // PARTS
    rows = rows.where(F.size("vector") == length)
    first = [r["vector"] for r in rows.orderBy(*order).limit(ENTRIES).collect()]
    books = np.moveaxis(integers(np.array(first).reshape(len(first), PARTS, width)), 1, 0)

    def plant(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks: dict[str, list] = {"vec_ids": [], "labels": [], "trees": []}
        for start in range(0, batch.num_rows, BLOCK):
            some = batch.slice(start, BLOCK)
            numbers = np.asarray(some.column("vector").flatten(), float).reshape(some.num_rows, PARTS, width)
            blocks["vec_ids"].append(some.column("vec_id").to_pylist())
            blocks["labels"].append(some.column("label").to_pylist())
            blocks["trees"].append([build(part).dump() for part in np.moveaxis(integers(numbers), 1, 0)])
        kinds = [pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.binary())]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(blocks.values(), kinds, strict=True)], list(blocks)
        )

    planted = map_batches(rows, plant, "vec_ids array<long>, labels array<string>, trees array<binary>")
    trees = cut(planted, "trees")
    for _ in range(ROUNDS):
        books = _renewed(trees, books)

    def write_codes(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: dict[str, list] = {"codes": [], "errors": []}
        for row in batch.column("trees"):
            found = [code(CoverTree.load(t.as_buffer()), book) for t, book in zip(row.values, books, strict=True)]
            out["codes"] += np.stack([c for c, _ in found], 1).tolist()
            out["errors"] += sum(e for _, e in found).tolist()
        arrays = [
            batch.column("vec_ids").flatten(), batch.column("labels").flatten(),
            pa.array(out["codes"], pa.list_(pa.int32())), pa.array(out["errors"], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(arrays, ["vec_id", "label", "codes", "error"])

    coded = cut(map_batches(trees, write_codes, "vec_id long, label string, codes array<int>, error long"), "codes")
    summed = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("label_error"))
    summed = cut(summed.select(F.col("label").alias("of"), F.expr("try_cast(label_error AS long)").alias("label_error")), "sums")
    few = summed.count() <= BROADCAST_LABELS
    same = F.col("label").eqNullSafe(F.col("of"))
    return coded.join(F.broadcast(summed) if few else summed.hint("merge"), same).drop("of"), books


def _renewed(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: entries become the means, rounded down, of the parts nearest to them."""

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, count = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for row in batch.column("trees"):
            for part, tree in enumerate(row.values):
                more = gather(CoverTree.load(tree.as_buffer()), books[part])
                total[part] += more[0]
                count[part] += more[1]
        part, entry = np.nonzero(count)
        lists = pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))
        names = ["part", "entry", "total", "count"]
        return pa.RecordBatch.from_arrays([pa.array(part), pa.array(entry), lists, pa.array(count[part, entry])], names)

    partial = map_batches(trees.select("trees"), apply, "part long, entry long, total array<long>, count long")
    components = [F.sum(F.col("total")[i]).alias(f"c{i}") for i in range(books.shape[2])]
    renewed = books.copy()
    for row in partial.groupBy("part", "entry").agg(F.sum("count").alias("n"), *components).collect():
        renewed[row["part"], row["entry"]] = [row[f"c{i}"] // row["n"] for i in range(books.shape[2])]
    return renewed
