"""Packing token sequences: shortest pack first, over the histogram of lengths.

Documents become token ids with a closing id, cut into pieces of at most ``capacity`` ids. Only the
histogram of piece lengths (at most ``capacity`` numbers) reaches the driver. There the lengths are
placed longest first, each into the packs that are the shortest so far; packs of one height are one
pattern with a count, so the work depends on the capacity, not on the number of pieces. What results
are runs: the pieces of one length with ranks r..r+n go to sequences s..s+n at one offset. Pieces get
their rank within their length by counting over partitions and join the runs by length and rank.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.tables import columns, cut, map_batches

CAPACITY = 2048
CLOSING_ID = 1
#: From about a million blanks in a row on, tiktoken's pattern overflows its stack and ends the task.
_LONG_BLANK = re.compile(r"(?<!\s)\s{100000}")
PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


@lru_cache(maxsize=2)
def encoder(path: str):
    """A tiktoken encoding made from a byte-level BPE file of the library ``tokenizers``.

    It gives the same ids several times faster. Texts are split by the pattern that these files share, and
    strings of special tokens are ordinary text.
    """
    import json

    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    # Byte-level files write each byte as one printable character; the others follow from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    singles = {c: i for c, i in model["vocab"].items() if len(c) == 1 and c in byte}
    ranks = {bytes([byte[c]]): i for c, i in singles.items()}
    for merge in model["merges"]:
        joined = "".join(merge.split(" ") if isinstance(merge, str) else merge)
        ranks[bytes(byte[c] for c in joined)] = model["vocab"][joined]
    return tiktoken.Encoding(
        "from-file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@lru_cache(maxsize=2)
def whole_encoder(path: str):
    """The tokenizer of the library ``tokenizers`` itself; special tokens are ordinary text."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def token_ids(path: str, text: str) -> list[int]:
    """The ids of a text. Where a run of white space is too long for tiktoken's pattern, the other library makes them."""
    if not _LONG_BLANK.search(text):
        return encoder(path).encode_ordinary(text)
    return whole_encoder(path).encode(text, add_special_tokens=False).ids


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """``PIECES`` rows: the ids of each document, closing id included, cut every ``capacity`` ids.

    ``ids`` are little-endian unsigned 32-bit. A NULL text counts as empty and has the closing id alone.
    """
    path = tokenizer or default_tokenizer()

    def cut_up(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[list] = [[], [], [], [], []]
        for key, value in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            tokens = token_ids(path, value.as_py() or "") + [CLOSING_ID]
            data = np.array(tokens, "<u4").tobytes()
            for start in range(0, len(tokens), capacity):
                piece = data[4 * start : 4 * (start + capacity)]
                for column, v in zip(out, (key, start, len(piece) // 4, len(tokens), piece), strict=True):
                    column.append(v)
        kinds = [pa.int64()] * 4 + [pa.binary()]
        names = ["doc_id", "start", "length", "doc_tokens", "ids"]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names
        )

    rows = columns(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_batches(rows, cut_up, PIECES)


def place(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) that place every length.

    Longest first; each goes to the packs of the smallest height, as many as there are, and where it
    fits into none, new packs are opened.
    """
    runs, heap, opened = [], [], 0
    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            if heap and heap[0][0] + length <= capacity:
                height, first, count = heapq.heappop(heap)
            else:
                height, first, count = 0, opened, left
                opened += count
            used = min(count, left)
            runs.append((length, rank, used, first, height))
            rank, left = rank + used, left - used
            if height + length < capacity:
                heapq.heappush(heap, (height + length, first, used))
            if used < count:
                heapq.heappush(heap, (height, first + used, count - used))
    return runs


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ``keep``, sequence_id, offset.

    ``keep`` names what is kept of the pieces (default: their ids). Sequences are gapless from offset 0.
    No documents give no rows. Which of several pieces of one length gets which place is not defined,
    but it is fixed once the pieces are written.
    """
    kept = keep if keep is not None else {"ids": F.col("ids")}
    cut_up = pieces(docs, doc_id, text, tokenizer, capacity).select(
        "doc_id", "start", "length", "doc_tokens", *[c.alias(n) for n, c in kept.items()]
    )
    # The part and the place in it are written down, so that a task that runs again finds the same.
    placed = cut_up.withColumn("at", F.monotonically_increasing_id())
    placed = cut(placed.withColumn("part", F.shiftright("at", 33)), "pieces")

    counts = cut(placed.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = placed.sparkSession.createDataFrame(
        place(histogram, capacity),
        "length long, first_rank long, count long, first_sequence long, offset long",
    )

    by_part = Window.partitionBy("length").orderBy("part")
    before = counts.select("length", "part", (F.sum("n").over(by_part) - F.col("n")).alias("before"))
    # Sorted like the pieces and not broadcast: its rows grow with the parts.
    before = cut(before, "before").hint("merge")
    inside = Window.partitionBy("part", "length").orderBy("at")
    ranked = (
        placed.withColumn("inside", F.row_number().over(inside) - 1)
        .join(before, ["part", "length"])
        .withColumn("rank", F.col("before") + F.col("inside"))
    )
    # At most a few runs for each of the capacity's lengths, whatever the number of pieces.
    here = F.col("rank").between(F.col("first_rank"), F.col("first_rank") + F.col("count") - 1)
    joined = ranked.join(F.broadcast(runs), "length").where(here)
    return joined.select(
        "doc_id", "start", "length", "doc_tokens", *kept,
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset",
    )
