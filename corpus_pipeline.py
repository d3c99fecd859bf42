"""A corpus in five stages, each written as Parquet and read again before the next.

language ID -> line dedup -> SimHash near-duplicates -> benchmark decontamination -> packing. Every
stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import decontaminate, language_id, line_dedup, packing, similar
from basketry.llm.tables import cut, held_out, read


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; the dictionaries come from three quarters of them."""
    return language_id.keep_identified(docs, ~held_out(F.col("doc_id"), 4, 2))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that earlier ones have; those with nothing left go."""
    found = line_dedup.dedup(docs)
    left = found.where((F.size("removed") == 0) | (F.btrim("kept_text") != ""))
    changed = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        counted = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size("removed") > 0, counted).otherwise(F.col("row.n_chars"))
    return left.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose five-word shingles are 0.8 similar, the one with the smallest id."""
    return similar.one_of_each_group(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage like an item of the table ``benchmark``."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of 2048 ids."""
    return packing.pack(docs, keep={"ids_crc32": F.crc32("ids")})


STAGES = [
    ("language_id", identified),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", decontaminated),
    ("packing", packed),
]

#: The stages hash, compress and align; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
