"""Line dedup by pairwise alignment: later documents lose the blocks that they share with earlier ones.

Documents meet through the hashes of lines they share. A line in at most ``RARE`` documents pairs each with
every earlier one; a line in more of them pairs each with the first, so every line of a later document
still meets an earlier one that has it, and no line makes more than ``RARE`` rows for a document. Lines of one
passage can have different firsts; so the shortest windows of neighbouring lines with enough words for a
block are posted too, and each pairs a document with the first that has the whole window. The common
lines of a pair are aligned by patience diff; a run of aligned lines with enough words is a common block
and is deleted from the later document. The first document with a line never loses it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.patience import align
from basketry.llm.tables import columns, cut, map_batches, map_partitions

RARE = 8
#: Words of a block that is deleted; shorter ones, such as a greeting, are no sign of a copy.
BLOCK_WORDS = 10
_SPOT = "struct<place: int, line_no: int, line: bigint, words: int>"
#: Windows that a task puts into one batch.
_WINDOWS = 10_000


def _key(doc_id: Column, text: Column) -> Column:
    """What orders and tells apart documents: the id, NULLs last, then a hash of the text."""
    return F.struct(
        F.isnull(doc_id).alias("none"), doc_id.cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key")
    )


def common_blocks(common: Sequence[tuple[list[int], list[int], int]], least: int = BLOCK_WORDS) -> list[int]:
    """Places in b of the blocks to delete, from the places in a and b and the words of each common line."""
    a = sorted((p, i) for i, (places, _, _) in enumerate(common) for p in places)
    b = sorted((p, i) for i, (_, places, _) in enumerate(common) for p in places)
    out, run, run_words, last = [], [], 0, (-2, -2)
    for i, j in align([x for _, x in a], [x for _, x in b]):
        here = (a[i][0], b[j][0])
        if here != (last[0] + 1, last[1] + 1):
            out += run if run_words >= least else []
            run, run_words = [], 0
        run.append(here[1])
        run_words += common[b[j][1]][2]
        last = here
    return out + (run if run_words >= least else [])


def windows(lines: Sequence[tuple[int, int, bool]], least: int = BLOCK_WORDS) -> list[tuple[int, int]]:
    """(first, last) of the shortest windows with ``least`` words, from (place, words, frequent) of lines in order.

    Each line begins one and ends one, so all lines of a longer block are in a window inside the block. Windows
    of a single line or without a frequent line are left out: those lines meet their partners by themselves.
    """
    found, start, words = set(), 0, 0
    for end, (place, n, _) in enumerate(lines):
        if end and place != lines[end - 1][0] + 1:
            start, words = end, 0
        words += n
        # Every start whose shortest window ends here; the last of them is the shortest window that ends here.
        if words >= least:
            while words - lines[start][1] >= least:
                found.add((start, end)) if words - n < least else None
                words -= lines[start][1]
                start += 1
            found.add((start, end))
    return sorted((a, b) for a, b in found if a < b and any(x[2] for x in lines[a : b + 1]))


def _posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, window, window2, spots) for each window of each document."""
    names = ["key", "window", "window2", "spots"]
    spot = pa.struct([("place", pa.int32()), ("line_no", pa.int32()), ("line", pa.int64()), ("words", pa.int32())])

    def rows(kind: pa.DataType, out: list) -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.int64(), pa.list_(spot)]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    for batch in batches:
        out, kind = [], batch.column("key").type
        for key, own in zip(batch.column("key").to_pylist(), batch.column("own"), strict=True):
            lines = own.as_py()
            for a, b in windows([(x["place"], x["words"], x["often"]) for x in lines]):
                of = lines[a : b + 1]
                digest = blake2b(b"".join(x[k].to_bytes(8, "little", signed=True) for x in of for k in ("line", "line2")), digest_size=16).digest()
                hashes = [int.from_bytes(digest[i : i + 8], "little", signed=True) for i in (0, 8)]
                out.append((key, *hashes, [{k: x[k] for k in ("place", "line_no", "line", "words")} for x in of]))
                if len(out) >= _WINDOWS:
                    yield rows(kind, out)
                    out = []
        if out:
            yield rows(kind, out)


def _met_by_windows(shared: DataFrame) -> DataFrame:
    """(a, b, line, words, a_places, b_places): lines of windows, with the first document that has the window."""
    often = F.col("documents") > RARE
    own = shared.select("key", F.explode("places").alias("at"), "line", F.col("line2").cast("long"), "words", often.alias("often"))
    spots = F.struct("at.place", "at.line_no", "line", "line2", "words", "often")
    docs = own.groupBy("key").agg(
        F.array_sort(F.collect_list(spots)).alias("own"), F.max("often").alias("some"), F.min("words").alias("least")
    )
    docs = docs.where(F.col("some") & (F.col("least") < BLOCK_WORDS)).select("key", "own")
    kind = docs.schema["key"].dataType.simpleString()
    posted = cut(map_partitions(docs, _posted, f"key {kind}, window bigint, window2 bigint, spots array<{_SPOT}>"), "windows")
    firsts = posted.groupBy("window", "window2").agg(
        F.min(F.struct("key", F.transform("spots", lambda x: x["place"]).alias("places"))).alias("a"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    firsts = cut(firsts.where("low < high").select("window", "window2", "a"), "first-windows")
    met = posted.join(firsts, ["window", "window2"]).where("key <> a.key")
    lines = met.select(F.col("a.key").alias("a"), F.col("key").alias("b"), F.explode(F.arrays_zip(F.col("spots").alias("s"), F.col("a.places").alias("p"))).alias("x"))
    return lines.groupBy("a", "b", F.col("x.s.line").alias("line")).agg(
        F.min("x.s.words").alias("words"), F.collect_set("x.p").alias("a_places"),
        F.collect_set(F.struct("x.s.place", "x.s.line_no")).alias("b_places"),
    )


def removed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, removed, partners) for each document that loses lines.

    ``key`` is struct (none, doc_id, text_key), ``removed`` the numbers of the lines from 0, ``partners``
    the ids of the documents that the blocks were aligned with. Lines are compared without white space at
    their ends; blank ones are passed over. Rows that repeat an id and its text are one document.
    """
    rows = columns(docs, doc_id=doc_id, text=text)
    lines = F.transform(
        F.split("text", "\n"), lambda x, i: F.struct(i.alias("line_no"), F.btrim(x, F.lit(" \t\r\x0b\x0c")).alias("line"))
    )
    full = F.filter(lines, lambda x: x["line"] != "")
    split = rows.where("text is not null").select(_key(F.col("doc_id"), F.col("text")).alias("key"), F.posexplode(full).alias("place", "own"))
    # Two hashes together tell lines apart.
    postings = split.select(
        "key", "place", "own.line_no",
        F.xxhash64("own.line").alias("line"), F.hash("own.line").alias("line2"),
        F.size(F.split("own.line", r"\s+")).alias("words"),
    )
    places = postings.groupBy("line", "line2", "key").agg(
        F.array_sort(F.collect_set(F.struct("place", "line_no"))).alias("places"), F.min("words").alias("words")
    )
    places = cut(places, "places")
    lines = places.groupBy("line", "line2").agg(F.count(F.lit(1)).alias("documents"), F.min("key").alias("first"))
    lines = cut(lines.where("documents > 1"), "lines")
    shared = cut(places.join(lines, ["line", "line2"]), "shared")

    b = shared.select("line", "line2", "documents", "first", "words", F.col("key").alias("b"), F.col("places").alias("b_places"))
    a = shared.select("line", "line2", "documents", "first", F.col("key").alias("a"), F.col("places").alias("a_places"))
    rare = F.col("documents") <= RARE
    few = b.where(rare).drop("documents", "first").join(a.where(rare).drop("documents", "first"), ["line", "line2"])
    firsts = cut(a.where(~rare).where("a = first").drop("documents", "first"), "first-places")
    many = b.where(~rare).where("b <> first").drop("documents", "first").join(firsts, ["line", "line2"])
    by_line = few.where("a < b").unionByName(many).drop("line2")
    by_line = by_line.withColumn("a_places", F.transform("a_places", lambda x: x["place"]))
    met = by_line.unionByName(_met_by_windows(shared))

    # A pair's common lines are no more than the lines of one document.
    pairs = met.groupBy("a", "b").agg(
        F.collect_list(F.struct(
            "line", "a_places", F.transform("b_places", lambda x: x["place"]).alias("b_places"), "words",
        )).alias("common"),
        F.flatten(F.collect_list("b_places")).alias("numbers"),
    ).where(F.aggregate("common", F.lit(0), lambda n, x: n + x["words"] * F.size(x["b_places"])) >= BLOCK_WORDS)

    def delete(batch: pa.RecordBatch) -> pa.RecordBatch:
        removed = []
        for common, numbers in zip(batch.column("common").to_pylist(), batch.column("numbers").to_pylist(), strict=True):
            line_no = {x["place"]: x["line_no"] for x in numbers}
            lines: dict[int, tuple[set, set, int]] = {}
            for c in common:  # a line may come by itself and in windows
                a_places, b_places, _ = lines.setdefault(c["line"], (set(), set(), c["words"]))
                a_places.update(c["a_places"])
                b_places.update(c["b_places"])
            found = common_blocks(list(lines.values()))
            removed.append([line_no[p] for p in found])
        kinds = pa.array(removed, pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), kinds], ["a", "b", "removed"])

    kind = pairs.schema["a"].dataType.simpleString()
    found = map_batches(pairs, delete, f"a {kind}, b {kind}, removed array<int>").where(F.size("removed") > 0)
    return found.groupBy(F.col("b").alias("key")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("removed")))).alias("removed"),
        F.array_sort(F.collect_set("a.doc_id")).alias("partners"),
    )


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows as struct ``row``, with removed, partners (both empty where nothing goes) and ``kept_text``.

    ``kept_text`` is the text without the removed lines: NULL for a NULL text, the text itself where no line
    goes, empty where all go.
    """
    found = cut(removed_lines(docs, doc_id, text), "removed")
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("text"),
        _key(docs[doc_id], docs[text]).alias("key"),
    )
    kept = F.array_join(
        F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("removed", i)), "\n"
    )
    none = F.array().cast("array<int>")
    return rows.join(found, "key", "left").select(
        "row",
        F.coalesce("removed", none).alias("removed"),
        F.coalesce("partners", F.array().cast("array<bigint>")).alias("partners"),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
    )
