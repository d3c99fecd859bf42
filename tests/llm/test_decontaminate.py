import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.llm import decontaminate
from basketry.llm.queries import op3_decontamination

from .conftest import prose

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return [tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))] if words else []


def plainly(docs, items, least=0.8):
    """The best window of the item's size, at its first place, for each document and item."""
    found = {}
    for item, text in items.items():
        own = shingles(text)
        if not own:
            continue
        bag, known = Counter(own), set(own)
        for doc, doc_text in docs.items():
            there = shingles(doc_text)
            if known.isdisjoint(there):
                continue
            best = (0, 0)
            for start in range(len(there)):
                window = there[start : start + len(own)]
                common = sum((bag & Counter(window)).values())
                best = max(best, (common / (len(own) + len(window) - common), -start))
            if best[0] >= least:
                found[doc, item] = (pytest.approx(best[0]), -best[1])
    return found


def run(spark, docs, items):
    d = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    b = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = decontaminate.contaminated(d, b).collect()
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    return {(r.doc_id, r.item_id): (r.similarity, r.start) for r in rows}


def test_registered_query_equals_brute_force(spark):
    docs, items = (
        {r[0]: r["text"] for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()} for t in ("documents", "benchmark")
    )
    got = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in op3_decontamination(spark, SF).collect()}
    assert got and got == plainly(docs, items)


def changed(text, at, word="changed"):
    words = text.split(" ")
    words[at] = word
    return " ".join(words)


def test_near_copies_down_to_the_threshold(spark):
    items = {i: prose(40 + i, 30 + 12 * i) for i in range(6)}
    docs, n = {}, 0
    for text in items.values():
        size = len(text.split(" "))
        for edit in (
            text, text.upper(), text.replace(" ", ", "), changed(text, 0), changed(text, size - 1), changed(text, 2),
            changed(text, size // 2), changed(changed(text, 5), size // 2), text.replace(" ", " und ", 2), " ".join(text.split(" ")[:-4]),
        ):
            docs[n] = f"{prose(500 + n, 25)}\n{edit} {prose(900 + n, 25)}"
            n += 1
    want = plainly(docs, items)
    got = run(spark, docs, items)
    assert got == want and len(want) > 30 and any(v[0] != 1 for v in want.values())


def test_short_repetitive_and_odd_texts(spark):
    items = {1: "one two three", 2: "", 3: None, 4: "la " * 40, 5: prose(70, 30), 6: prose(70, 30), 7: "!!"}
    docs = {1: "One, two three!", 2: "one two three four", 3: "la " * 41, 4: "la " * 300, 5: prose(70, 30), 6: "", 7: None, 8: "??", 9: prose(70, 27)}
    assert run(spark, docs, items) == plainly(docs, items)


def test_fingerprints_and_similarity_by_hand(make):
    rows = make("a array<bigint>, b array<bigint>", ([3, 3, 5], [3, 5, 5, 9]), ([-1], [-1]))
    got = rows.select(
        decontaminate.simhash(F.col("a")).alias("print"),
        decontaminate.weighted_similarity(F.col("a"), F.col("b")).alias("similarity"),
    ).collect()
    assert [r["print"] for r in got] == [3, -1]
    assert [r["similarity"] for r in got] == [pytest.approx(2 / 5), 1.0]


def test_clean_keeps_the_rest_as_it_is(hard_docs, hard_rows, spark):
    benchmark = spark.createDataFrame([(1, prose(1, 80)), (None, None)], "item_id long, text string")
    kept = decontaminate.clean(hard_docs, benchmark)
    assert kept.columns == hard_docs.columns
    assert kept.count() == len(hard_rows) - 4  # three copies and the document that holds one
    assert kept.where("doc_id in (1, 2, 11)").count() == 0


def test_nothing(no_docs, hard_docs, hard_rows, spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(no_docs, benchmark).count() == 0
    assert decontaminate.clean(hard_docs, benchmark).count() == len(hard_rows)
