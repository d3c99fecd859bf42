"""Language identification by compression: the dictionary that fits makes the text smallest.

For each language a raw-content zstandard dictionary is made of whole training texts. A text is cut into
blocks of a few kilobytes, all of which are compressed with each dictionary; the language with the
smallest total wins. A block starts with nothing but the dictionary, so a long text can't fall back on
its own repetitions. Where the runner-up comes close, the text is marked as rejected.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.tables import columns, map_batches

#: Bounds of the model: for each language one text for each of so many hash buckets and so many bytes of a
#: dictionary; all dictionaries together. Of more languages than fit in, each gets an equal, smaller share.
BUCKETS, DICTIONARY_BYTES, MODEL_BYTES = 256, 110_000, 64 * 110_000
BLOCK_BYTES = 4096
#: zstandard's level for blocks.
LEVEL = 6
#: The runner-up must be larger by this share of the smallest size.
MARGIN = 0.01
#: A code-length gap of one byte counts as so many nats of evidence; repeated words make gaps too large.
EVIDENCE = 0.25
#: Characters that a dictionary takes from the beginning of a drawn text.
SAMPLE = 8192
UNDETERMINED = "und"
_NO_LETTERS = regex.compile(r"\P{L}+")


def letters(text: str) -> bytes:
    """Lower-case letters, with one space for all between them, so that case and marks don't count."""
    return _NO_LETTERS.sub(" ", text.lower()).strip().encode()


def dictionaries(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> dict[str, bytes]:
    """A dictionary for each language, made of texts of ``labelled``; NULLs and texts without letters are left out.

    The sample is bounded, the same for the same rows in any order, and drawn by the hash of ``key``: in
    each language the row with the smallest hash in each bucket, of whatever length, of which up to ``SAMPLE``
    characters are used. Every language that has such a text is learned. The language with the most rows comes first.
    """
    rows = columns(labelled, text=text, lang=lang, key=key).where("lang is not null and text is not null")
    rows = rows.where(F.col("text").rlike(r"\p{L}")).withColumn("draw", F.xxhash64(F.col("key").cast("string"), "lang"))
    # One row for each language: the model has a dictionary for each.
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    languages = [r["lang"] for r in sizes.collect()]
    if not languages:
        return {}
    most = min(DICTIONARY_BYTES, max(1, MODEL_BYTES // len(languages)))
    buckets = max(1, BUCKETS * most // DICTIONARY_BYTES)
    drawn = rows.groupBy("lang", F.pmod("draw", F.lit(buckets)).alias("bucket")).agg(F.min("draw").alias("draw"))
    ids = [tuple(r) for r in drawn.select("lang", "draw").collect()]
    wanted = F.broadcast(rows.sparkSession.createDataFrame(ids, "lang string, draw long"))
    texts = rows.join(wanted, ["lang", "draw"]).groupBy("lang", "draw").agg(F.min("text").alias("text"))
    # From the first letter on, so that a long run of other signs leaves something to learn from.
    start = F.substring(F.regexp_replace("text", r"^\P{L}+", ""), 1, min(SAMPLE, most))
    found = {lang: b"" for lang in languages}
    for row in sorted(texts.select("lang", "draw", start.alias("text")).collect(), key=lambda r: (r["lang"], r["draw"])):
        sample = found[row["lang"]]
        if len(sample) < most:
            found[row["lang"]] = sample + letters(row["text"]) + b" "
    return {lang: sample for lang, sample in found.items() if sample}


@lru_cache(maxsize=2)
def _compressors(model: tuple[tuple[str, bytes], ...]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    out = []
    for lang, content in model:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        out.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False)))
    return out


def classify(text: str | None, model: tuple[tuple[str, bytes], ...]) -> tuple[str, float, bool]:
    """Language, score and whether the margin is too narrow."""
    plain = letters(text) if text and model else b""
    if not plain:
        return UNDETERMINED, 0.0, True
    blocks = [plain[i : i + BLOCK_BYTES] for i in range(0, len(plain), BLOCK_BYTES)]
    compressors = _compressors(model)
    sizes = np.array([sum(len(c.compress(b)) for b in blocks) for _, c in compressors], float)
    best = int(sizes.argmin())  # a tie goes to the language with more training texts
    score = 1 / np.exp(np.maximum((sizes[best] - sizes) * EVIDENCE, -700)).sum()
    others = np.delete(sizes, best)
    narrow = bool(len(others) and others.min() < sizes[best] * (1 + MARGIN))
    return compressors[best][0], float(score), narrow


def identify(docs: DataFrame, model: dict[str, bytes], text: str = "text") -> DataFrame:
    """All columns of ``docs`` as struct ``row``, with lang_pred, score (0 to 1) and rejected.

    A text that is NULL or has no letter, or any text if nothing was learned, is ``und`` and rejected.
    """
    frozen = tuple(model.items())
    shared = docs.sparkSession.sparkContext.broadcast(frozen)  # bounded: see MODEL_BYTES

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [classify(t.as_py(), shared.value) for t in batch.column("row").field(place)]
        predicted = [pa.array([f[i] for f in found]) for i in range(3)]
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), *predicted], ["row", "lang_pred", "score", "rejected"]
        )

    # The text goes to the workers once, inside the row.
    place = docs.columns.index(text)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    kind = T.StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double")
    return map_batches(rows, apply, kind.add("rejected", "boolean"))


def keep_identified(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` without the rows that are rejected; the model is learned from the rows where ``learn`` holds."""
    model = dictionaries(docs.where(learn), text, lang)
    return identify(docs, model, text).where("not rejected").select("row.*")
