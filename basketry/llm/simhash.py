"""SimHash near-duplicates: fingerprints that differ in at most two bits, in linear work.

Fingerprints are split into four blocks of sixteen bits. Two that differ in at most two bits agree on
at least two whole blocks (pigeonhole), so each of the six pairs of blocks is a key of 32 bits;
fingerprints that share a key are compared and their Hamming distance is verified.

Equal fingerprints are one node, so a group of exact copies costs one row. A key shared by many
different fingerprints (a large group of near copies) is not compared pair by pair: each of them names
the points within one bit, inside the bits the key leaves free. Two fingerprints differ in at most
two bits exactly if they share such a point, and at most 33 fingerprints name the same one, so linking
all that name a point to the smallest of them finds the same components in linear work.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import components
from basketry.llm.tables import columns, cut, map_batches, texts_as_bytes

BITS, BLOCKS, RADIUS = 64, 4, 2
#: Different fingerprints under one key that are still compared pair by pair.
PAIRWISE = 32
SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: bytes, words: int = 3) -> int:
    """A bit is set if it is set in over half of the shingles' hashes; no words give 0."""
    tokens = text.lower().split()  # of bytes: only A-Z change, only ASCII white space separates
    if not tokens:
        return 0
    starts = range(max(1, len(tokens) - words + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(b" ".join(tokens[i : i + words]), SEED) for i in starts), "<u8", len(starts)
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _CHUNK):  # a very long text needs no more memory
        rows = hashes[at : at + _CHUNK].view(np.uint8).reshape(-1, BITS // 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, print, text_key) for each row; ``print`` holds the 64 bits as a signed long.

    A NULL text counts as empty. ``text_key`` is a hash of the text that tells apart rows of one id.
    """

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(t or b"") for t in texts_as_bytes(batch, "text")]
        signed = pa.array(np.array(prints, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), signed, batch.column("text_key")],
            ["doc_id", "print", "text_key"],
        )

    rows = columns(docs, doc_id=doc_id, text=text)
    rows = rows.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    return map_batches(rows, apply, "doc_id long, print long, text_key long")


def _masks() -> list[int]:
    width = BITS // BLOCKS
    block = [((1 << width) - 1) << (i * width) for i in range(BLOCKS)]
    masks = [sum(chosen) for chosen in combinations(block, BLOCKS - RADIUS)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) that connect just the different ``print`` values within the radius.

    Every pair under a key of up to ``PAIRWISE`` values is an edge; under a larger key there are
    enough edges for the same components, each of them within the radius.
    """
    masks = _masks()
    keys = F.explode(
        F.array(*[F.struct(F.lit(i).alias("n"), F.col("print").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)])
    )
    keyed = prints.select("print", keys.alias("key")).select("key.n", "key.part", "print")
    sizes = cut(keyed.groupBy("n", "part").count().where("count > 1"), "keys")
    shared = cut(keyed.join(sizes, ["n", "part"]), "shared")

    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    few = shared.where(F.col("count") <= PAIRWISE).select("n", "part", F.col("print").alias("a"))
    pairs = few.join(few.withColumnRenamed("a", "b"), ["n", "part"]).where("a < b").where(near)

    flips = {
        i: [0, *((1 << b) - (1 << BITS if b == BITS - 1 else 0) for b in range(BITS) if not m >> b & 1)]
        for i, m in enumerate(masks)
    }
    many = shared.where(F.col("count") > PAIRWISE)
    points = [
        many.where(F.col("n") == i).select(
            "print", F.explode(F.array(*[F.col("print").bitwiseXOR(F.lit(x)) for x in flip])).alias("point")
        )
        for i, flip in flips.items()
    ]
    named = points[0]
    for more in points[1:]:
        named = named.union(more)
    around = named.groupBy("point").agg(F.collect_set("print").alias("prints"))
    stars = around.where(F.size("prints") > 1).select(
        F.array_min("prints").alias("a"), F.explode("prints").alias("b")
    )
    return pairs.select("a", "b").union(stars.where("a <> b")).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, print, text_key, component_id, keeps.

    ``component_id`` is the smallest doc_id of the group, NULL if all its ids are NULL. ``keeps`` is true
    for the rows of that id; where rows of one id have different texts, for the one of the smallest
    ``text_key``. Empty and NULL texts have the print 0 and are linked like any other.
    """
    rows = cut(fingerprints(docs, doc_id, text), "prints")
    order = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_key")
    prints = cut(rows.groupBy("print").agg(F.min(order).alias("first")), "firsts")
    roots = components(links(prints.select("print")))
    rooted = prints.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    rooted = cut(rooted, "rooted")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("keeper"))
    grouped = cut(rooted.join(cut(firsts, "keepers"), "root"), "grouped")
    found = rows.join(grouped.select("print", "root", "keeper"), "print")
    keeps = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & F.col("text_key").eqNullSafe(F.col("keeper.text_key"))
    return found.select(
        "doc_id", "print", "text_key", "root", F.col("keeper.doc_id").alias("component_id"), keeps.alias("keeps")
    )


def one_of_each_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, all columns as they were.

    The row of the smallest doc_id stays. Rows that repeat its id and text count as one.
    """
    kept = near_duplicates(docs, doc_id, text).where("keeps").select("doc_id", "text_key").distinct()
    kept = cut(kept.select(F.struct("doc_id", "text_key").alias("key")), "kept")
    row = docs.select(
        F.struct(docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("text_key")).alias("key"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    )
    return row.join(kept, "key").dropDuplicates(["key"]).select("row.*")
