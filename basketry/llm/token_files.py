"""Token ids as files: frequency-ranked ids in a byte-aligned variable-length code.

``write`` makes a folder with two parts, both Parquet, so that Spark's committer and readers take care of lost tasks and
of any file system:

``ranks``
    (rank, id): the ids that occur, the most frequent one at rank 0. Ids are coded by their rank.
``blocks``
    (file, block, before, doc_ids, n_tokens, control, data): whole documents in ascending order of
    their doc_id, NULL first; those of one doc_id by number of ids and then by a hash. Blocks are ordered by file and
    block, and ``before`` is the number of ids before the block in its file. Four ranks share a byte of ``control``, two
    bits each, lowest first: 0 to 3 for one to four bytes of ``data``, the lowest byte first. Every document begins
    with a control byte of its own, so each can be decoded alone; what its last control byte has to spare is zero and has
    no data.

A block has documents whose ids, with two or four bytes each, take about ``BLOCK`` bytes, or one longer document; a
reader's memory is bounded by that. Decoding looks the lengths up by control byte, sums them up to places, and gathers the bytes with numpy for a
block at once.

Ids come from the library ``tokenizers``. Where a tokenizer first splits at white space, as the default one does, a
word's ids don't depend on its neighbours, so each worker asks the library once for each different word and remembers
the answer; with another tokenizer it asks for whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.tables import columns, cut, map_partitions, slices

CLOSING_ID = 1
#: Bytes that the ids of a block take before they are coded.
BLOCK = 1 << 22
#: Words (of up to so many bytes) whose ids a worker remembers.
REMEMBERED, WORD_BYTES = 1 << 20, 64
#: A word that stands between others; control characters are words of their own.
_BORDER = b"\x01"
#: Lower-case letters up to U+00FF, and marks after them that neither begin a contraction nor combine with others.
_LETTERS, _MARKS = "a-zß-öø-ÿ", ".,;:!?%&#)"
#: Bytes of text or of ids that are worked on at once; a longer text is worked on alone.
_PART = 1 << 23

#: For each control byte, how many bytes its four ranks have.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Words:
    """Ids of texts by a tokenizer file, word by word where it splits at white space.

    ``plain`` is the same model without the file's steps before it, which leave lower-case letters as they are. It
    gets those of a word that ends in letters and marks, if the file's steps give the same for samples.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        steps = [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        self.plain.normalizer, self.plain.pre_tokenizer = None, pre_tokenizers.Sequence(steps)
        self.known: dict[bytes, bytes] = {}
        border = self._ids(_BORDER)
        self.border = int(np.frombuffer(border, "<u4")[0])
        alone = [self._ids(word) for word in (b"a", b"bc", b"d", b",;")]
        self.by_word = self._ids(b"a bc\nd ,; " + _BORDER) == b"".join([*alone, border]) and len(border) == 4
        joined, letters = self._ids("Aü böc,;".encode()), [self._ids(x.encode(), self.plain) for x in ("aü", "böc")]
        self.by_letters = self.by_word and joined == b"".join([*letters, alone[-1]])
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.by_letters &= all(self.ends[np.frombuffer(x, "<u4")].tolist()[-2:] in ([False, True], [True]) for x in letters)

    def _ids(self, text: bytes, tokenizer=None) -> bytes:
        (found,) = (tokenizer or self.whole).encode_batch_fast([text.decode()], add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def _learn(self, words: list[bytes], letters: bool) -> None:
        """Remember the ids of words, asked for in one text."""
        if letters:  # each word is one piece, and a piece's last id tells that it is the last
            ids = self._ids(b" ".join(words), self.plain)
            ends = 4 * np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 4
            starts = [0, *ends.tolist()]
        else:  # with a word of its own between them
            self.known.update((w, self._ids(w)) for w in words if _BORDER in w)
            words = [w for w in words if _BORDER not in w]
            ids = self._ids((b" %b " % _BORDER).join([*words, b""]))
            ends = 4 * np.flatnonzero(np.frombuffer(ids, "<u4") == self.border)
            starts = [0, *(ends + 4).tolist()]
        self.known.update((w, ids[a:b]) for w, a, b in zip(words, starts, ends.tolist(), strict=False))

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words, one after another, and how many each has.

        What is done word by word in Python is done for different heads and marks only.
        """
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        lower = pc.ascii_lower(words)
        plain = pc.match_substring_regex(lower, f"^[{_LETTERS}]+[{_MARKS}]*$")
        plain = pc.and_(plain, pa.scalar(self.by_letters))
        heads = pc.if_else(plain, pc.ascii_rtrim(lower, characters=_MARKS), words)
        longer = np.flatnonzero(pc.not_equal(pc.binary_length(heads), pc.binary_length(words)).to_numpy(zero_copy_only=False))
        tails = pc.replace_substring_regex(words.take(pa.array(longer)), f"^[A-Z{_LETTERS}]+", "").dictionary_encode()
        heads = heads.dictionary_encode()
        letters = pc.match_substring_regex(heads.dictionary, f"^[{_LETTERS}]+$").to_pylist()
        pieces, marks = (x.dictionary.cast(pa.binary()).to_pylist() for x in (heads, tails))
        new = [(w, x and self.by_letters) for w, x in zip(pieces, letters, strict=True) if w not in known]
        self._learn([w for w, x in new if x], True)
        self._learn(list(dict.fromkeys([w for w, x in new if not x] + [w for w in marks if w not in known])), False)
        every = [*pieces, *marks]
        ids = [known[w] for w in every]
        # The last piece is that of a word without marks after it.
        sizes = np.array([*map(len, ids), 0], np.int64) // 4
        flat = np.frombuffer(bytearray().join(ids), "<u4")
        for word in [w for w in every if len(w) > WORD_BYTES]:
            known.pop(word, None)  # marks may be a word too
        order = np.full((len(words), 2), len(ids))
        order[:, 0] = heads.indices.to_numpy()
        order[longer, 1] = len(pieces) + tails.indices.to_numpy()
        each = sizes[order]
        return flat[_stretches((np.cumsum(sizes) - sizes)[order.ravel()], each.ravel())], each.sum(1)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts and their closing ids, one after another, and the number of ids of each text."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            found = [np.frombuffer(self._ids(t), "<u4") for t in texts.cast(pa.binary()).to_pylist()]
            parts = [x for ids in found for x in (ids, [CLOSING_ID])]
            return np.concatenate([np.empty(0, "<u4"), *parts]).astype("<u4"), np.array([len(i) + 1 for i in found], np.int64)
        split = pc.ascii_split_whitespace(texts)
        words = split.flatten().dictionary_encode()
        flat, sizes = self._of_words(words.dictionary)
        different = len(sizes)
        # The last one of the different words is the closing id, after the words of each text.
        flat, sizes = np.append(flat, np.uint32(CLOSING_ID)), np.append(sizes, 1)
        many = np.diff(split.offsets.to_numpy())
        order = np.full(len(words) + len(texts), different, np.int64)
        order[np.arange(len(words)) + np.repeat(np.arange(len(texts)), many)] = words.indices.to_numpy()
        out = flat[_stretches((np.cumsum(sizes) - sizes)[order], sizes[order])]
        before = np.concatenate([[0], np.cumsum(sizes[order])])
        return out, np.diff(before[np.concatenate([[0], np.cumsum(many + 1)])])


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1 .. of each stretch, one after another."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


def encode(ranks: np.ndarray, n_tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control and data bytes of documents that follow one another in ``ranks``, and where each one's bytes end."""
    ranks = ranks.astype("<u4")
    more = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= more[:, None]]
    controls = -(-n_tokens // 4)
    codes = np.zeros(4 * int(controls.sum()), np.uint8)
    codes[_slots(n_tokens)] = more
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    sizes = np.concatenate([[0], np.cumsum(more.astype(np.int64) + 1)])
    return control, data, np.cumsum(controls), sizes[np.cumsum(n_tokens)]


def _slots(n_tokens: np.ndarray) -> np.ndarray:
    """The places of documents' ids among those that their control bytes have room for."""
    spare = np.cumsum(-n_tokens % 4) - (-n_tokens % 4)
    return np.arange(int(n_tokens.sum())) + np.repeat(spare, n_tokens)


def decode(control: np.ndarray, data: np.ndarray, n_tokens: np.ndarray) -> np.ndarray:
    """The ranks of documents that follow one another."""
    sizes = LENGTHS[control].ravel()[_slots(n_tokens)]
    at = np.cumsum(sizes, dtype=np.int64) - sizes
    out = data[at].astype("<u4")
    for byte in range(1, 4):
        longer = np.flatnonzero(sizes > byte)
        out[longer] |= data[at[longer] + byte].astype("<u4") << np.uint32(8 * byte)
    return out


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One value for each stretch of bytes."""
    offsets = pa.array(np.concatenate([[0], ends]), pa.int64())
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.binary())


def token_ids(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None, kind: str = "<u4"
) -> DataFrame:
    """(doc_id, n_tokens, ids): each document's ids and the closing id, by default little-endian unsigned 32-bit.

    A NULL text counts as empty and has the closing id alone. ``tokenizer`` is a file of the library ``tokenizers``.
    """
    path = tokenizer or default_tokenizer()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for batch in batches:
            for part in slices(batch, "text", _PART):
                ids, lengths = words.ids(part.column("text"))
                packed = _binary(ids.astype(kind).view(np.uint8), np.dtype(kind).itemsize * np.cumsum(lengths))
                arrays = [part.column("doc_id"), pa.array(lengths), packed]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_tokens", "ids"])

    rows = columns(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    return map_partitions(rows, apply, "doc_id long, n_tokens long, ids binary")


def _counts(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """How often each id occurs in a partition."""
    total = np.zeros(0, np.int64)
    for batch in batches:
        for part in slices(batch, "ids", _PART):
            seen = np.bincount(np.frombuffer(b"".join(part.column("ids").to_pylist()), kind))
            if len(seen) > len(total):
                total, seen = seen.astype(np.int64), total
            total[: len(seen)] += seen
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])


_BLOCK = "file int, block int, before long, doc_ids array<long>, n_tokens array<long>, control binary, data binary"


def write(
    docs: DataFrame,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    block: int = BLOCK,
) -> None:
    """Write the ids of all documents to ``folder``; see the module for the files.

    A NULL text has the closing id alone. Repeated rows and rows of one doc_id are all written. No documents give
    no blocks.
    """
    spark = docs.sparkSession
    # The ids decide between rows of one doc_id, so that the files are always the same; the last key
    # divides equal rows among the partitions.
    order = ["doc_id", "n_tokens", "hash", "at"]
    kind = "<u2" if len(words_of(tokenizer or default_tokenizer()).ends) <= 1 << 16 else "<u4"
    found = token_ids(docs, doc_id, text, tokenizer, kind).withColumn("hash", F.xxhash64("ids"))
    found = cut(found.withColumn("at", F.monotonically_increasing_id()), "ids", compression="zstd")
    counted = map_partitions(found.select("ids"), partial(_counts, kind=kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # One row for each id of the vocabulary at most.
    ordered = np.array([r["id"] for r in sorted(counted.collect(), key=lambda r: (-r["n"], r["id"]))], np.int64)
    ranked = pa.table({"rank": pa.array(np.arange(len(ordered)), pa.int32()), "id": pa.array(ordered)})
    spark.createDataFrame(ranked, "rank int, id long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/ranks")
    rank_of = np.zeros(int(ordered.max(initial=0)) + 1, "<u4")
    rank_of[ordered] = np.arange(len(ordered))
    given = spark.sparkContext.broadcast(rank_of)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, before = TaskContext.get().partitionId(), 0
        parts = (part for batch in batches for part in slices(batch, "ids", block))
        for number, part in enumerate(parts):
            lengths = part.column("n_tokens").to_numpy()
            ids = np.frombuffer(b"".join(part.column("ids").to_pylist()), kind)
            control, data, *_ = encode(given.value[ids], lengths)
            whole = pa.array([0, part.num_rows], pa.int32())
            yield pa.RecordBatch.from_pydict({
                "file": pa.array([file], pa.int32()), "block": pa.array([number], pa.int32()),
                "before": pa.array([before], pa.int64()),
                "doc_ids": pa.ListArray.from_arrays(whole, part.column("doc_id")),
                "n_tokens": pa.ListArray.from_arrays(whole, part.column("n_tokens")),
                "control": pa.array([control.tobytes()]), "data": pa.array([data.tobytes()]),
            })
            before += int(lengths.sum())

    rows = found.repartitionByRange(*order).sortWithinPartitions(*order).drop("hash", "at")
    written = map_partitions(rows, blocks, _BLOCK).write.mode("overwrite")
    written.option("compression", "zstd").parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in a written folder.

    ``start`` is the number of ids of all documents before it; ``ids`` are little-endian unsigned 32-bit.
    """
    blocks = spark.read.parquet(f"{folder}/blocks")
    # A row for each id and for each file: both are bounded, by the vocabulary and the shuffle's partitions.
    ranked = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toArrow()
    ids = ranked.column("id").to_numpy().astype("<u4")
    sizes = blocks.select("file", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    start, at = {}, 0
    for row in sorted(sizes.groupBy("file").agg(F.sum("n").alias("n")).collect()):
        start[row["file"]], at = at, at + row["n"]
    given = spark.sparkContext.broadcast((ids, start))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, start = given.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                lengths = row["n_tokens"].values.to_numpy()
                control, data = (np.frombuffer(row[c].as_buffer(), np.uint8) for c in ("control", "data"))
                found = ids[decode(control, data, lengths)]
                ends = np.cumsum(lengths)
                first = start[row["file"].as_py()] + row["before"].as_py()
                arrays = [
                    row["doc_ids"].values, pa.array(first + ends - lengths), pa.array(lengths),
                    _binary(found.view(np.uint8), 4 * ends),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "start", "n_tokens", "ids"])

    return map_partitions(blocks, apply, "doc_id long, start long, n_tokens long, ids binary")
