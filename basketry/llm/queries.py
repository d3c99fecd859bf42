"""Registered queries of the operators, each over its whole table, and their SQL where SQL can express it."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    ctw,
    decontaminate,
    embeddings,
    language_id,
    licenses,
    line_dedup,
    packing,
    periodic,
    pii,
    simhash,
    token_files,
    url_rules,
    vector_codes,
)
from basketry.llm.tables import held_out, read
from basketry.sources import paths


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "row.doc_id", F.size("removed").alias("n_removed"), "removed", "partners",
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents"))

    def listed(spans: str):
        named = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
        return F.array_join(named, ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [number(kind) for kind in pii.KINDS]
    digest = F.sha2(listed("base").cast("binary"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), listed("spans").alias("spans"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return ctw.score(docs.withColumn("held_out", held_out(F.col("doc_id"), 10, 0)))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held", held_out(F.col("doc_id"), 4, 2))
    model = language_id.dictionaries(docs.where("not held"))
    # A prediction gets the text and nothing else of the row.
    found = language_id.identify(docs.select("doc_id", "held", "text"), model)
    return found.select(
        "row.doc_id", F.coalesce("row.held", F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), keep={"ids_crc32": F.crc32("ids")})


def labelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs with a label: ``block`` where the label of the same number is toxic or of low quality."""
    labels = read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        F.when((F.col("toxic") == 1) | (F.col("quality") == 0), "block").otherwise("allow").alias("label"),
    )
    return read(spark, sf_dir, "pages").select("page_id", "url").join(labels, "page_id")


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = url_rules.mine(labelled_pages(spark, sf_dir))
    return url_rules.judge(read(spark, sf_dir, "pages"), rules).drop("url")


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read(spark, sf_dir, "embeddings"))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one of ten documents the words from a place on repeat the first p of them.

    Place and p follow from the crc32 of the doc_id; a document without one stays as it is.
    """
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    by = F.floor(hashed / 10)
    size = F.size("words")
    start = by % size
    period = 1 + F.floor((size - start) / (3 + by % 8))
    again = F.transform(
        F.sequence("start", size.cast("long") - 1),
        lambda i: F.get("words", (F.col("start") + (i - F.col("start")) % F.col("period")).cast("int")),
    )
    chosen = docs.select("doc_id", "text").withColumn("words", F.when(hashed % 10 == 0, words))
    planted = chosen.withColumn("start", F.when(size > 0, start)).withColumn("period", F.when(size > 0, period))
    changed = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("start").cast("int")), again), " ")
    return planted.select("doc_id", F.when(F.col("start").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find(with_planted_periods(read(spark, sf_dir, "documents")))
    # Runs come by start and period, so that the first of equally long ones stays.
    greatest = F.aggregate(
        "runs",
        F.get("runs", F.lit(0)),
        lambda best, run: F.when(run["length"] * best["period"] > best["length"] * run["period"], run).otherwise(best),
    )
    line = lambda run: F.concat_ws(",", *[run[k].cast("string") for k in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda run: F.concat(line(run), F.lit("\n"))), "")
    return found.withColumn("best", greatest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, codebooks = vector_codes.compress(read(spark, sf_dir, "embeddings"))
    digits = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c.cast("long")), 2, "0")))
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    return found.select(
        "vec_id", F.array_join(digits, "").alias("code"), "error", "label_error",
        F.lit(digest).alias("codebooks_sha256"),
    )


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = paths.work_folder(spark, "token-files")
    token_files.write(read(spark, sf_dir, "documents"), folder)
    return token_files.read(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def queries() -> dict:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_pii": op2_pii,
        "op3_decontamination": op3_decontamination,
        "op4_context_tree": op4_context_tree,
        "op5_language_id": op5_language_id,
        "op6_simhash": op6_simhash,
        "op7_licenses": op7_licenses,
        "op8_packing": op8_packing,
        "op9_url_rules": op9_url_rules,
        "op10_embeddings": op10_embeddings,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_vector_codes": op12_vector_codes,
        "op13_token_files": op13_token_files,
    }


#: Every window of an item's size that has a shingle of it, compared exactly.
_OP3_SQL = r"""
WITH texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
words AS (
  SELECT side, id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM texts),
spread AS (
  SELECT side, id, greatest(len(w) - 4, 1) AS n, unnest(range(0, greatest(len(w) - 4, 1))) AS place, w FROM words
  WHERE len(w) > 0),
shingles AS (SELECT side, id, n, place, array_to_string(w[place + 1:place + 5], ' ') AS s FROM spread),
items AS (SELECT id AS item_id, n, s, count(*) AS times FROM shingles WHERE side = 'b' GROUP BY ALL),
hits AS (
  SELECT d.id AS doc_id, d.n AS doc_n, i.item_id, i.n, d.place, d.s, i.times
  FROM shingles d JOIN items i ON d.s = i.s WHERE d.side = 'd'),
starts AS (
  SELECT DISTINCT doc_id, doc_n, item_id, n, unnest(range(greatest(place - n + 1, 0), place + 1)) AS start FROM hits),
common AS (
  SELECT w.doc_id, w.doc_n, w.item_id, w.n, w.start, h.s, least(count(*), any_value(h.times)) AS shared
  FROM starts w JOIN hits h ON w.doc_id = h.doc_id AND w.item_id = h.item_id
    AND h.place >= w.start AND h.place < w.start + w.n
  GROUP BY ALL),
scored AS (
  SELECT doc_id, item_id, start, n,
    sum(shared) / (n + least(n, doc_n - start) - sum(shared)) AS similarity
  FROM common GROUP BY doc_id, doc_n, item_id, n, start)
SELECT doc_id, item_id, similarity, CAST(start AS INTEGER) AS start, CAST(n AS INTEGER) AS n FROM scored
WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1"""

#: All pairs of a label, and components by passing on the smallest number along links.
_OP10_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS node, vec_id AS low FROM embeddings
  UNION SELECT l.b, r.low FROM reach r JOIN links l ON r.node = l.a WHERE r.low < l.b),
roots AS (SELECT node, min(low) AS component_id FROM reach GROUP BY node),
counts AS (SELECT a AS node, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN roots r ON e.vec_id = r.node LEFT JOIN counts c ON e.vec_id = c.node"""

#: Every part against every entry of its codebook, in each round.
_OP12_ROUND = """
near{n} AS (
  SELECT vec_id, label, p, any_value(x) AS x,
    min(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - e[i]) * (x[i] - e[i]))) * 64 + k) AS best
  FROM parts JOIN book{n} USING (p) GROUP BY vec_id, label, p),
book{m} AS (
  SELECT b.p, b.k, coalesce(any_value(r.e), any_value(b.e)) AS e FROM book{n} b LEFT JOIN (
    SELECT p, k, list(CAST((s - ((s % c + c) % c)) / c AS BIGINT) ORDER BY i) AS e FROM (
      SELECT p, best % 64 AS k, i, sum(x[i])::BIGINT AS s, count(*) AS c
      FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM near{n}) GROUP BY ALL) GROUP BY ALL) r
  ON b.p = r.p AND b.k = r.k GROUP BY b.p, b.k)"""
_OP12_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT vec_id, label, p, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x
  FROM (SELECT *, unnest(range(16)) AS p FROM kept)),
book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS e FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
{_OP12_ROUND.format(n=0, m=1)},
{_OP12_ROUND.format(n=1, m=2)},
{_OP12_ROUND.format(n=2, m=3).split("),\nbook3")[0]}),
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error
  FROM near2 GROUP BY vec_id, label),
digest AS (
  SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, k, i)) AS codebooks_sha256
  FROM (SELECT p, k, unnest(e) AS y, unnest(range(len(e))) AS i FROM book2))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT codebooks_sha256 FROM digest) AS codebooks_sha256
FROM coded"""


def oracle_sql() -> dict[str, str]:
    """SQL of the queries it can express; the others are tested by brute force."""
    return {
        "op3_decontamination": _OP3_SQL,
        "op10_embeddings": _OP10_SQL,
        "op12_vector_codes": _OP12_SQL,
    }
