"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Texts are words (letters and digits, lower case) and shingles of five of them. A window has as many shingles
as an item; it is contaminated if the bags of shingles of window and item, weighted by how often each
shingle is there, have a Jaccard similarity of ``SIMILARITY`` or more.

Windows and items are fingerprinted with SimHash. Of 64 bits, four blocks of sixteen: fingerprints within
``RADIUS`` = 19 bits have a block with at most four differing bits (five in each would be twenty), so items are
indexed under all values within four bits of each block and every fingerprint within the radius is found.
Candidates of one size are then compared exactly.

A window that similar shares at least ``SIMILARITY`` of an item's shingles, so only windows with so many
shingles of items of their size are fingerprinted; the others can't pass the exact check.
Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.tables import columns, cut

WORDS, SIMILARITY, RADIUS = 5, 0.8, 19
_BLOCKS, _WIDTH = 4, 16
_NEAR = RADIUS // _BLOCKS
#: Shingles of a benchmark that are broadcast, about 32 bytes each; a larger benchmark is joined by sorting.
BROADCAST_SHINGLES = 2_000_000


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _zipped(words: str) -> Column:
    """Array of structs of five words in a row; fewer words make one struct, no words none."""
    n = F.greatest(F.size(words) - (WORDS - 1), F.least(F.size(words), F.lit(1)))
    return F.arrays_zip(*[F.slice(words, i + 1, n).alias(f"w{i}") for i in range(WORDS)])


def _texts(rows: DataFrame) -> DataFrame:
    """(key, words) of the distinct texts of ``rows``; ``key`` is two hashes of the text."""
    return rows.select(_key(F.col("text")).alias("key"), _words(F.col("text")).alias("words"))


def _key(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.hash(text).alias("b"))


def _hashes(words: str) -> Column:
    """The shingles' hashes, in order."""
    return F.transform(_zipped(words), lambda x: F.xxhash64(*[x[f"w{i}"] for i in range(WORDS)]))


def simhash(hashes: Column) -> Column:
    """64 bits, each set if it is set in over half of the hashes."""

    def bit(i: Column) -> Column:
        ones = F.aggregate(
            hashes, F.lit(0), lambda n, h: n + F.call_function("shiftright", h, i).bitwiseAND(F.lit(1)).cast("int")
        )
        return F.when(ones * 2 > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda all_, i: all_.bitwiseOR(bit(i))
    )


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of the lesser over the sum of the greater counts of two arrays' elements."""

    def times(array: Column, x: Column) -> Column:
        return F.size(F.filter(array, lambda y: y == x))

    common = F.aggregate(
        F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x))
    )
    return common / (F.size(a) + F.size(b) - common)


def _blocks(fingerprint: Column) -> Column:
    """Explodes a fingerprint to (block, value)."""
    mask = F.lit((1 << _WIDTH) - 1)
    return F.inline(F.array(*[
        F.struct(F.lit(i).alias("block"), F.shiftright(fingerprint, i * _WIDTH).bitwiseAND(mask).cast("int").alias("value"))
        for i in range(_BLOCKS)
    ]))


def items_of(benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(item, n, shingles, print) of the distinct texts with words; ``item`` is their key."""
    texts = _texts(columns(benchmark, text=text).where("text is not null")).dropDuplicates(["key"])
    hashed = texts.where(F.size("words") > 0).select(F.col("key").alias("item"), _hashes("words").alias("shingles"))
    return hashed.select("item", F.size("shingles").alias("n"), "shingles", simhash(F.col("shingles")).alias("print"))


def windows_of(docs: DataFrame, items: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(key, start, n, shingles, print) of all windows with enough shingles of items of their size."""
    spark = docs.sparkSession
    known = items.select(F.explode("shingles").alias("h"), "n").distinct()
    known = cut(known, "known")
    if known.count() <= BROADCAST_SHINGLES:
        known = F.broadcast(known)
    texts = columns(docs, text=text).where("text is not null and text <> ''")
    split = _texts(texts)
    at = split.select("key", F.posexplode(_zipped("words")).alias("at", "w"))
    at = at.select("key", "at", F.xxhash64(*[F.col("w")[f"w{i}"] for i in range(WORDS)]).alias("h"))
    # Copies of a text bring equal hits, which count once.
    hits = at.join(known, "h").select("key", "n", "at").distinct()
    least = F.ceil(F.col("n") * similarity - 1e-9)
    enough = hits.groupBy("key", "n").count().where(F.col("count") >= least).select("key", "n")
    hits = cut(hits.join(enough, ["key", "n"], "left_semi"), "hits")
    # Bounded by one text: the windows of one size in it.
    lists = hits.groupBy("key", "n").agg(F.array_sort(F.collect_list("at")).alias("places"))
    at_least = least.cast("int")
    spread = (F.col("n") - at_least).cast("int")
    # The hit that is at_least - 1 hits later must lie within the window that starts at this one.
    firsts = F.filter(
        F.col("places"), lambda p, i: F.get(F.col("places"), i + at_least - 1) < p + F.col("n")
    )
    starts = F.array_distinct(F.flatten(F.transform(firsts, lambda p: F.sequence(F.greatest(p - spread, F.lit(0)), p))))
    starting = lists.select("key", F.explode(starts).alias("start"), "n")
    of_text = cut(starting.groupBy("key").agg(F.collect_list(F.struct("start", "n")).alias("windows")), "starts")

    found = texts.select(_key(F.col("text")).alias("key"), "text").join(of_text.select("key"), "key", "left_semi")
    found = found.groupBy("key").agg(F.min("text").alias("text")).join(of_text, "key")
    hashed = found.select("key", "windows", _words(F.col("text")).alias("words")).select("key", "windows", _hashes("words").alias("all"))
    cut_out = hashed.select("key", F.inline(F.transform(
        "windows", lambda w: F.struct(w["start"].alias("start"), w["n"].alias("n"), F.slice("all", w["start"] + 1, w["n"]).alias("shingles"))
    )))
    return cut_out.withColumn("print", simhash(F.col("shingles")))


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(key, item, similarity, start, n): for each contaminated text and item the most similar window.

    ``key`` and ``item`` are hashes of the texts, ``start`` the first word from 0 and ``n`` the number of shingles;
    a tie goes to the first window. NULL and empty texts and items without words never match; a text or item
    of fewer than five words is one shingle.
    """
    spark = docs.sparkSession
    items = cut(items_of(benchmark), "items")
    windows = cut(windows_of(docs, items, text, similarity), "windows")
    flips = spark.createDataFrame(
        [(b, f) for b in range(_BLOCKS) for f in range(1 << _WIDTH) if f.bit_count() <= _NEAR],
        T.StructType([T.StructField("block", T.IntegerType()), T.StructField("flip", T.IntegerType())]),
    )
    # The flips are the same some thousand rows whatever the data.
    index = items.select("item", "n", "print", _blocks(F.col("print"))).join(F.broadcast(flips), "block")
    index = index.select("item", "n", F.col("print").alias("item_print"), "block", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    probes = windows.select("key", "start", "n", "print", _blocks(F.col("print")))
    apart = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    near = probes.join(index, ["n", "block", "value"]).where(apart <= RADIUS)
    pairs = near.select("key", "start", "n", "item").distinct()
    compared = pairs.join(windows.select("key", "start", "n", "shingles"), ["key", "start", "n"]).join(
        items.select("item", F.col("shingles").alias("item_shingles")), "item"
    )
    alike = compared.withColumn("similarity", weighted_similarity(F.col("shingles"), F.col("item_shingles")))
    best = alike.where(F.col("similarity") >= similarity).groupBy("key", "item").agg(
        F.min(F.struct((-F.col("similarity")).alias("less"), "start", "n")).alias("best")
    )
    return best.select("key", "item", (-F.col("best.less")).alias("similarity"), "best.start", "best.n")


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per contaminated row of ``docs`` and item: doc_id, item_id, similarity, start, n."""
    found = cut(leaks(docs, benchmark, text), "leaks")
    of_items = columns(benchmark, item_id=item_id, text="text").select("item_id", _key(F.col("text")).alias("item")).distinct()
    of_docs = columns(docs, doc_id=doc_id, text=text).select("doc_id", _key(F.col("text")).alias("key"))
    return of_docs.join(found.join(of_items, "item"), "key").select("doc_id", "item_id", "similarity", "start", "n")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window like an item, all columns as they were."""
    found = cut(leaks(docs, benchmark, text).select("key").distinct(), "leaks")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), _key(docs[text]).alias("key"))
    return rows.join(found, "key", "left_anti").select("row.*")
