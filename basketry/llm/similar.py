"""Groups of similar texts: long SimHash fingerprints, blocks of their bits as keys, and an exact join for what they miss.

Two texts are similar if their sets of ``words``-word shingles have a Jaccard similarity of at least ``similarity``. Then
a bit of their fingerprints differs with a known probability, about 0.15 at 0.8. A 64-bit fingerprint tells too little
there: ten bits differ, and no block of it that is long enough to be selective is likely to agree. So fingerprints
have ``BITS`` bits, and blocks are drawn from them: as many bits as make random texts meet seldom, and as many blocks as
let similar ones meet with probability ``RECALL``.

A few texts that agree on a block are compared pair by pair; of many, all are compared with one of them, the pivot. So a block
that thousands of near copies share costs a comparison for each of them, not for each pair. Comparisons check the Hamming
distance, and what passes is decided by the shingles themselves.

What fingerprints miss is found without chance. Of two similar texts, each has a shingle of the other among its first
n - ceil(similarity * n) + 1 hashes, in any order that is the same for all texts. Here shingles that many texts have come last, so
passages that go around and the text that a crowd of copies was made of are no keys but of texts that have little else. A sample
tells which these are; the order changes the work only. Texts that share a key and are not in one group yet are all compared: if their
sizes allow the similarity, and so do the hashes before the key and those that one of them has alone, then by parities (each shingle turns
a bit, so at least as many shingles differ as bits do), and then by the shingles themselves. So the groups are those of all similar pairs.
Hashes that one has alone are known without comparing: one among its first, up to where those of the other end, is missing there
if it is among no other text's first. So texts of their own that share a common line make no pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.components import components
from basketry.llm.tables import columns, cut, map_batches, slices, texts_as_bytes

#: ``RECALL`` is that of the fingerprints alone; the groups don't depend on it.
BITS, RECALL = 512, 0.5
SEED = 42
#: Texts that random others meet in one block on average, as a power of two.
_SPARE_BITS = 3
#: Nodes whose texts are looked for by broadcast; of more they are joined by sorting.
BROADCAST_NODES = 200_000
#: Nodes that agree on a block and are still compared pair by pair.
PAIRWISE = 32
#: Shares of an average prefix at which the hashes that a node has alone are counted, besides all of them.
PARTS = (0.5, 0.75, 0.9)
#: One of so many texts is looked at for frequent shingles; so many of these texts have a frequent one; the most that are kept.
SAMPLED, OFTEN, MOST_FREQUENT = 32, 4, 1 << 20
_CHUNK, _PART = 1 << 13, 1 << 22
#: What a product may be wrong by; sizes are whole numbers.
_ROUNDING = 1e-6
#: Turns an unsigned number's order into that of signed ones.
_SIGN = -(1 << 63)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted hashes of the different shingles; a shorter text is one shingle, none if it has no words."""
    tokens = text.lower().split()  # of bytes: only A-Z change, only ASCII white space separates
    if not tokens:
        return np.empty(0, "<u8")
    digest, starts = xxhash.xxh64_intdigest, range(max(1, len(tokens) - words + 1))
    return np.unique(np.fromiter((digest(b" ".join(tokens[i : i + words]), SEED) for i in starts), "<u8", len(starts)))


def fingerprint(hashes: np.ndarray) -> bytes:
    """Bits that are set in over half of the shingles' hashes, each drawn out to ``BITS`` bits; no shingles give 0."""
    counts, streams = np.zeros(BITS, np.int64), np.arange(1, BITS // 64 + 1, dtype=np.uint64) * _ODD[0]
    for at in range(0, len(hashes), _CHUNK):
        x = hashes[at : at + _CHUNK, None] + streams
        x = (x ^ (x >> np.uint64(30))) * _ODD[1]
        x = (x ^ (x >> np.uint64(27))) * _ODD[2]
        x ^= x >> np.uint64(31)
        counts += np.unpackbits(x.view(np.uint8), axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(2 * counts > len(hashes)).tobytes()


def differing(similarity: float) -> float:
    """The share of bits that differ between texts of a Jaccard similarity and about equal length."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def radius(similarity: float) -> int:
    """Differing bits that a pair at the similarity doesn't exceed but in one of a thousand cases."""
    share = differing(similarity)
    return math.ceil(BITS * share + 3.1 * math.sqrt(BITS * share * (1 - share)))


def blocks(nodes: int, similarity: float) -> np.ndarray:
    """The places of the bits of each block, a row each."""
    width = min(40, math.ceil(math.log2(max(nodes, 2))) + _SPARE_BITS)
    many = math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - differing(similarity)) ** width))
    draw = np.random.default_rng(SEED)
    return np.stack([draw.choice(BITS, width, replace=False) for _ in range(many)])


def ordered(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Sorted hashes as keys of 63 bits, the frequent ones (sorted too) after all others by the bit above these."""
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    often = frequent[at] == hashes if len(frequent) else np.zeros(len(hashes), bool)
    keys = hashes >> np.uint64(1)
    return np.concatenate([keys[~often], keys[often] | np.uint64(1 << 63)])


def prefix(hashes: np.ndarray, similarity: float) -> np.ndarray:
    """The first hashes, of which each similar set has one among its own."""
    return hashes[: len(hashes) - math.ceil(similarity * len(hashes) - _ROUNDING) + 1]


def parities(hashes: np.ndarray) -> bytes:
    """For each class of hashes whether their number is odd; classes are a power of two, twice the hashes at least."""
    classes = max(BITS, 1 << (2 * len(hashes)).bit_length())
    numbers = np.bincount((hashes & np.uint64(classes - 1)).astype(np.int64), minlength=classes)
    return np.packbits(numbers & 1, bitorder="little").tobytes()


def odd_differences(ones: list[bytes], others: list[bytes]) -> np.ndarray:
    """In how many classes the parities of each pair differ; of two numbers of classes the smaller one counts."""
    out = np.zeros(len(ones), np.int64)
    sizes = np.array([[len(x), len(y)] for x, y in zip(ones, others, strict=True)]).reshape(-1, 2)
    for some in np.unique(sizes, axis=0):
        at = np.flatnonzero((sizes == some).all(1))
        # A class of the smaller number holds those of the larger one that end in the same bits.
        folded = [
            np.bitwise_xor.reduce(np.frombuffer(b"".join([side[i] for i in at]), "<u8").reshape(len(at), -1, some.min() // 8), 1)
            for side in (ones, others)
        ]
        out[at] = np.bitwise_count(folded[0] ^ folded[1]).sum(1)
    return out


def print_differences(ones: list[bytes], others: list[bytes]) -> np.ndarray:
    """In how many bits the fingerprints of each pair differ."""
    one, other = (np.frombuffer(b"".join(x), "<u8").reshape(-1, BITS // 64) for x in (ones, others))
    return np.bitwise_count(one ^ other).sum(1)


def frequent_shingles(docs: DataFrame, words: int) -> np.ndarray:
    """Sorted hashes of shingles that several texts of a sample have, of rows (text, text_key)."""

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t or b"", words).view(np.int64) for p in slices(batch, "text", _PART) for t in texts_as_bytes(p, "text")]
        return pa.RecordBatch.from_arrays([batch.column("text_key"), pa.array(found, pa.list_(pa.int64()))], ["text_key", "hashes"])

    some = docs.where(F.pmod(F.xxhash64("text_key"), F.lit(SAMPLED)) == 0).select("text", "text_key")
    sets = map_batches(some, apply, "text_key long, hashes array<long>").dropDuplicates(["text_key"])
    counts = sets.select(F.explode("hashes").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("texts"))
    most = counts.where(F.col("texts") >= OFTEN).orderBy(F.desc("texts"), "key").limit(MOST_FREQUENT)
    return np.sort(most.select("key").toArrow().column("key").to_numpy().view("<u8"))


def fingerprints(docs: DataFrame, words: int, similarity: float, frequent: np.ndarray | None = None) -> DataFrame:
    """(doc_id, text_key, same, n, print, odd, prefix) for each row of (doc_id, text, text_key).

    ``same`` is a digest of the ``n`` shingles, ``odd`` their parities.
    """
    last = np.empty(0, "<u8") if frequent is None else frequent
    names = ["same", "n", "print", "odd", "prefix"]

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for part in slices(batch, "text", _PART):
            for text in texts_as_bytes(part, "text"):
                x = shingles(text or b"", words)
                first = prefix(ordered(x, last), similarity).view(np.int64)
                found.append((xxhash.xxh3_128_digest(x.tobytes()), len(x), fingerprint(x), parities(x), first))
        kinds = [pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        arrays = [pa.array(list(c), k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), *arrays], ["doc_id", "text_key", *names])

    return map_batches(
        docs, apply, "doc_id long, text_key long, same binary, n long, print binary, odd binary, prefix array<long>"
    )


def _keyed(nodes: DataFrame, places: np.ndarray) -> DataFrame:
    """(key, node) for each block of each node; a key holds the number of its block."""
    weights, first = 1 << np.arange(places.shape[1], dtype=np.int64), np.arange(len(places), dtype=np.int64) << 41

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = []
        for start in range(0, batch.num_rows, 1000):
            some = batch.slice(start, 1000).column("print").to_pylist()
            bits = np.unpackbits(np.frombuffer(b"".join(some), np.uint8).reshape(len(some), -1), axis=1)
            keys.append((bits[:, places].astype(np.int64) @ weights + first).ravel())
        values = pa.array(np.concatenate(keys))
        offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(places))
        return pa.RecordBatch.from_arrays([batch.column("node"), pa.ListArray.from_arrays(offsets, values)], ["node", "keys"])

    found = map_batches(nodes.select("node", "print"), apply, "node long, keys array<long>")
    return found.select(F.explode("keys").alias("key"), "node")


def _near(
    pairs: DataFrame, nodes: DataFrame, column: str, differences: Callable, most: Callable[[np.ndarray], np.ndarray | int]
) -> DataFrame:
    """The (pivot, node) pairs that differ in at most ``most`` bits of a column; ``most`` is given the sums of their sizes."""

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        near = differences(batch.column("a").to_pylist(), batch.column("b").to_pylist()) <= most(batch.column("size").to_numpy())
        return batch.select(["pivot", "node"]).filter(pa.array(near))

    bits = nodes.select("node", F.col(column).alias("b"), F.col("n").alias("m"))
    one = bits.select(F.col("node").alias("pivot"), F.col("b").alias("a"), F.col("m").alias("l"))
    joined = pairs.join(bits, "node").join(one, "pivot").select("pivot", "node", "a", "b", (F.col("l") + F.col("m")).alias("size"))
    return map_batches(joined, apply, "pivot long, node long")


def _shingles(text: Column, words: int) -> Column:
    """Hashes of the different shingles of a text, as ``shingles`` divides it; by functions of Spark, so that texts stay where they are."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = F.filter(F.split(lower, r"[\x20\x09-\x0D]+"), lambda x: x != "")

    def made(t: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(t) - (words - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(t, i, words)))

    every = F.transform(F.array(tokens), lambda t: F.when(F.size(t) > 0, made(t)).otherwise(F.array().cast("array<long>")))
    return F.array_distinct(every[0])


def _alike(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs whose shingles are similar, compared exactly."""
    meant = pairs.select("node").union(pairs.select("pivot")).distinct().join(nodes.select("node", "first"), "node")
    meant = cut(meant.select("node", "first.doc_id", "first.text_key"), "meant")
    small = meant.count() <= BROADCAST_NODES
    key = docs["doc_id"].eqNullSafe(meant["doc_id"]) & docs["text_key"].eqNullSafe(meant["text_key"])
    texts = docs.join(F.broadcast(meant) if small else meant, key).select("node", "text").dropDuplicates(["node"])
    sets = cut(texts.select("node", _shingles(F.coalesce("text", F.lit("")), words).alias("b")), "shingles")
    one = sets.select(F.col("node").alias("pivot"), F.col("b").alias("a"))
    both = F.size(F.array_intersect("a", "b"))
    joined = pairs.join(sets, "node").join(one, "pivot")
    return joined.where(both >= similarity * (F.size("a") + F.size("b") - both)).select("pivot", "node")


def _met_in_blocks(nodes: DataFrame, similarity: float) -> DataFrame:
    """(pivot, node) pairs that agree on a block of the fingerprint; in large blocks those with the smallest node."""
    keyed = _keyed(nodes, blocks(nodes.count(), similarity))
    low = keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("met"))
    met = cut(keyed.join(cut(low.where("met > 1"), "pivots"), "key"), "met")
    few = met.where(F.col("met") <= PAIRWISE).select("key", "node")
    pairs = few.withColumnRenamed("node", "pivot").join(few, "key").where("pivot < node").select("pivot", "node")
    many = met.where((F.col("met") > PAIRWISE) & (F.col("node") != F.col("pivot")))
    return cut(pairs.union(many.select("pivot", "node")).distinct(), "pairs")


def _alone(met: DataFrame, nodes: DataFrame, bounds: list[int]) -> DataFrame:
    """(node, n, odd_0, odd_1, last, alone, alone_0 ..): parities of 128 classes; the last key of a prefix and how many of it are in
    no other prefix, in all and below each bound."""
    parts = [f"alone_{i}" for i in range(len(bounds))]
    unsigned = np.array([b - _SIGN for b in bounds], "<u8")

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        prefixes = [x.values.to_numpy().view("<u8") for x in batch.column("prefix")]
        last = np.array([x[-1] if len(x) else 0 for x in prefixes], "<u8").view(np.int64) ^ np.int64(_SIGN)
        below = np.array([[len(x), *np.searchsorted(x, unsigned)] for x in prefixes], np.int64)
        odd = np.stack([np.bitwise_xor.reduce(np.frombuffer(x.as_buffer(), "<i8").reshape(-1, 2), 0) for x in batch.column("odd")])
        return pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), *map(pa.array, (*odd.T, last, *below.T))], names)

    names = ["node", "n", "odd_0", "odd_1", "last", "alone", *parts]
    sizes = map_batches(nodes.select("node", "n", "prefix", "odd"), apply, ", ".join(f"{c} long" for c in names))
    key = F.col("key").bitwiseXOR(F.lit(_SIGN))
    in_others = [F.count(F.lit(1)).alias("more"), *[F.count_if(key < b).alias(f"more_{i}") for i, b in enumerate(bounds)]]
    both = sizes.join(met.groupBy("node").agg(*in_others), "node")
    return both.select(*names[:5], *[(F.col(c) - F.col(c.replace("alone", "more"))).alias(c) for c in ["alone", *parts]])


def _met_in_prefixes(nodes: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(pivot, node) pairs that share a hash of their prefixes and have other roots, if neither has too many hashes alone."""
    keyed = nodes.select(F.posexplode("prefix").alias("place", "key"), "node")
    shared = cut(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("met")).where("met > 1").select("key"), "shared")
    met = keyed.join(shared, "key").join(roots, "node", "left")
    met = cut(met.withColumn("root", F.coalesce("root", "node")), "met")
    bounds = [int((1 - similarity) * part * (1 << 63)) + _SIGN for part in PARTS]
    alone = cut(_alone(met, nodes, bounds), "alone")
    apart = met.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    met = cut(met.join(cut(apart.select("key"), "apart"), "key"), "apart").join(alone, "node")
    names = [c for c in met.columns if c != "key"]
    other = met.select("key", *[F.col(c).alias(f"other_{c}") for c in names])
    near_sizes = F.least("n", "other_n") >= similarity * F.greatest("n", "other_n") - _ROUNDING
    common = similarity / (1 + similarity) * (F.col("n") + F.col("other_n")) - _ROUNDING

    def enough(one: str, end: str) -> Column:
        """Whether a set can have as many hashes in common as it must, by those it has alone up to the other's last one."""
        missing = F.when(F.col(f"{one}last") <= F.col(end), F.col(f"{one}alone"))
        for i, bound in reversed(list(enumerate(bounds))):
            missing = missing.when(F.col(end) >= bound, F.col(f"{one}alone_{i}"))
        return F.col(f"{one}n") - missing.otherwise(0) >= common

    pairs = met.join(other, "key").where((F.col("other_node") < F.col("node")) & (F.col("root") != F.col("other_root")) & near_sizes)
    # At the first key that two share, neither has what the other has before it.
    pairs = pairs.where(F.col("place") + F.col("other_place") <= F.col("n") + F.col("other_n") - 2 * common)
    odd = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"other_{c}"))) for c in ("odd_0", "odd_1")), F.lit(0))
    pairs = pairs.where(odd <= F.col("n") + F.col("other_n") - 2 * common)
    pairs = pairs.where(enough("", "other_last") & enough("other_", "last"))
    return cut(pairs.select(F.col("other_node").alias("pivot"), "node").distinct(), "pairs")


def links(nodes: DataFrame, docs: DataFrame, words: int, similarity: float) -> DataFrame:
    """(a, b) of similar nodes: enough for their groups. ``nodes`` is a written table."""
    most, share = radius(similarity), (1 - similarity) / (1 + similarity)

    def alike(pairs: DataFrame, *bits) -> DataFrame:
        return cut(_alike(cut(_near(pairs, nodes, *bits), "near"), nodes, docs, words, similarity), "alike")

    found = alike(_met_in_blocks(nodes, similarity), "print", print_differences, lambda size: most)
    roots = components(found.select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    rest = _met_in_prefixes(nodes, cut(roots, "roots"), similarity)
    if not rest.isEmpty():
        found = found.union(alike(rest, "odd", odd_differences, lambda size: share * size + _ROUNDING))
    return found.select(F.col("pivot").alias("a"), F.col("node").alias("b"))


def groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8
) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, component_id and keeps.

    ``component_id`` is the smallest doc_id of the row's group, NULL if all its ids are NULL. ``keeps`` is true for the
    rows of that id; where rows of one id have different texts, for those of the smallest ``text_key``. Texts without
    words, NULL ones too, are one group. No rows give no rows.
    """
    rows = columns(docs, doc_id=doc_id, text=text)
    rows = rows.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    prints = cut(fingerprints(rows, words, similarity, frequent_shingles(rows, words)), "prints")
    order = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "text_key")
    one_of = [F.any_value(c).alias(c) for c in ("n", "print", "odd", "prefix")]
    nodes = prints.groupBy("same").agg(F.min(order).alias("first"), *one_of)
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = components(links(nodes, rows, words, similarity))
    rooted = nodes.join(roots, "node", "left").select("same", "first", F.coalesce("root", "node").alias("root"))
    rooted = cut(rooted, "rooted")
    keepers = cut(rooted.groupBy("root").agg(F.min("first").alias("keeper")), "keepers")
    grouped = cut(rooted.join(keepers, "root").select("same", "keeper"), "grouped")
    keeps = F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & F.col("text_key").eqNullSafe(F.col("keeper.text_key"))
    return prints.join(grouped, "same").select(
        "doc_id", "text_key", F.col("keeper.doc_id").alias("component_id"), keeps.alias("keeps")
    )


def one_of_each_group(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8
) -> DataFrame:
    """``docs`` with one row of each group of similar texts, all columns as they were.

    The row of the smallest doc_id stays. Rows that repeat its id and text count as one.
    """
    found = groups(docs, doc_id, text, words, similarity)
    kept = cut(found.where("keeps").select(F.struct("doc_id", "text_key").alias("key")).distinct(), "kept")
    row = docs.select(
        F.struct(docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(docs[text]).alias("text_key")).alias("key"),
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
    )
    return row.join(kept, "key").dropDuplicates(["key"]).select("row.*")
