import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from basketry.llm import pii
from basketry.llm.queries import op2_pii

SF = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(x) <= 255 for x in match.split(".")),
        "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
        "phone": lambda: 10 <= len(digits) <= 15,
    }[kind]()


def plainly(text):
    spans = [
        (m.start(), i, kind, m.end())
        for i, (kind, expression) in enumerate(PLAIN.items())
        for m in re.finditer(expression, text or "")
        if good(kind, m[0])
    ]
    return sorted(spans)


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def test_registered_query_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op2_pii(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        base = plainly(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        for kind in PLAIN:
            assert r[f"n_{kind}"] == sum(s[2] == kind for s in base)
        assert set(listed(base).split(",")) <= set(r.spans.split(",")) | {""}


def test_random_and_very_long_texts(spark):
    draw = random.Random(5)
    parts = ["a", "b", "1", "2", "55", "255", "256", "@", ".", "-", " ", "+", "(", ")", "%", "_", "é"]
    parts += ["\U0001f600", "4111 1111 1111 1111", "1.2.3.4", "+1 (203) 555-8282", "x@y.z"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(50))) for _ in range(1500)]
    long = {"1" * 200_000: [], "a" * 200_000: [], "a@" + "b." * 50_000 + "c": [(0, 100_003)], "+1" + " " * 100_000 + "2": []}
    rows = list(enumerate([*texts, *long, "", None]))
    got = {r.doc_id: r.spans for r in pii.given_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        spans = [(s.start, s.place, s.kind, s.end) for s in got[i]]
        if text in long:
            assert [(a, e) for a, _, _, e in spans] == long[text]
        else:
            assert spans == plainly(text)


@pytest.fixture
def letters(spark):
    rows = [(i, f"well then my mail is user{i}@mail.example.com and so on") for i in range(30)]
    rows += [(100, "oh, my mail is bob77(at)site ok"), (101, "so \nthe mail\tis \U0001f600 zed9(at)abc, yes")]
    rows += [(102, "\U0001f600 é mail is kim42(at)home"), (103, "this mail is nice"), (104, "their bob78(at)site ok")]
    rows += [(105, "and my mail is 1234123412341234 no card")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_sure_patterns_lead_to_new_identifiers(letters):
    texts = {r.doc_id: r.text for r in letters.collect()}
    found = pii.find(letters).where("doc_id >= 100").collect()
    got = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans] for r in found}
    assert got == {
        100: [("email", "bob77(at)site")],
        101: [],  # the token after the pattern is no identifier
        102: [("email", "kim42(at)home")],
        103: [],
        104: [],
        105: [],  # a number that was judged before
    }
    assert all(r.base == [] for r in found)


def test_patterns_that_lead_elsewhere_add_nothing(spark, letters):
    more = spark.range(200, 400).selectExpr("id as doc_id", "'the mail is late' as text")
    assert pii.find(letters.union(more)).where("doc_id >= 100 and size(spans) > 0").count() == 0


def test_a_rare_sure_context_counts_among_any_number_of_seeds(spark):
    rows = [(i, f"w{i} v{i} +1203555{i:04}") for i in range(3000)]
    rows += [(5000 + i, f"then call desk +1204555{i:04} now") for i in range(3)]
    rows += [(6000, "please call desk ext-5512 now")]
    found = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s.kind, s.start, s.end) for s in found[6000]] == [("phone", 17, 25)]


def test_numbers_that_no_expression_judged_are_found(spark):
    rows = [(i, f"so my phone is +1203555{i:04} thanks") for i in range(30)]
    new = ["555-123-4567", "2035558282", "DE89370400440532013000", "203 555 8282", "(203) 555 8282", "555 12"]
    judged = ["1234123412341234", "1234 1234 1234 1234", "+123-45", "1.2.3.400"]
    rows += [(100 + i, f"ok 7 8 my phone is {x}, thanks") for i, x in enumerate(new + judged)]
    found = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    got = [[(s.kind, texts[100 + i][s.start : s.end]) for s in found[100 + i]] for i in range(len(new + judged))]
    want = [[("phone", x.lstrip("("))] for x in new]
    assert got == want + [[]] * len(judged)


def spans_of(spark, rows) -> dict[int, list[str]]:
    texts = dict(rows)
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.spans] for r in found}


def test_patterns_follow_from_what_was_discovered(spark):
    rows = [(i, f"call my phone +1203555{i:04} now") for i in range(5)]
    rows += [(100 + i, f"or my phone 555-777-00{i:02} now") for i in range(3)]
    # The same numbers after other words, and others after these: a pattern that no given number shows.
    rows += [(200 + i, f"so reach me 555-777-00{i:02} now") for i in range(3)]
    rows += [(300 + i, f"so reach me 555-888-11{i:02} now") for i in range(3)]
    # And once more, from the numbers found last.
    rows += [(400 + i, f"my new line 555-888-11{i:02} ok") for i in range(3)] + [(500, "my new line 555-999-2222 ok")]
    rows += [(600 + i, f"see item no 12-{i:04} there") for i in range(20)]
    found = spans_of(spark, rows)
    texts = dict(rows)
    for i, text in rows:
        number = [w for w in text.split() if w[0] in "+5" or w.startswith("555")]
        assert found[i] == ([] if i >= 600 else number), text


def test_a_number_that_is_found_spreads_to_no_context_of_many_things(spark):
    rows = [(i, f"call my phone +1203555{i:04} now") for i in range(5)]
    rows += [(100 + i, f"or my phone 555-777-00{i:02} now") for i in range(3)]
    rows += [(200 + i, f"it was like 555-777-00{i:02} now") for i in range(3)]
    rows += [(300 + i, f"it was like word{'x' * i} now") for i in range(40)] + [(400, "it was like 2024-11-30 then")]
    found = spans_of(spark, rows)
    assert found[400] == [] and found[200] == ["555-777-0000"][:0] and found[100] == ["555-777-0000"]


def test_words_that_are_cut_off_are_no_pattern(spark):
    long = "x" * 100
    rows = [(i, f"{long} is +1203555{i:04} now") for i in range(9)] + [(100, f"{long} is 555-777-0000")]
    rows += [(200, f"{'x' * 77} is 555-777-0000")]
    exact = "y" * 70
    rows += [(300 + i, f"{exact} is +1204555{i:04} now") for i in range(9)] + [(400, f"{exact} is 555-777-1111")]
    found = spans_of(spark, rows)
    assert found[100] == [] and found[200] == [] and found[400] == ["555-777-1111"]


def test_only_places_of_candidates_are_counted(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(200)) + f" my phone +1203555{i:04}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    contexts = spark.createDataFrame([("my phone",)], "context string")
    assert [tuple(r) for r in pii._followers(docs, contexts).collect()] == [("my phone", None, 50)]
    every, possible = pii._places(docs), pii._possible(pii._places(docs), contexts)
    assert every.count() == 50 * 201 and 50 <= possible.count() < 50 * 201 / 16
    assert "Join" not in possible._jdf.queryExecution().executedPlan().toString()


def test_every_place_of_a_context_is_possible(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("concat('w', id) x", "concat('v', id % 50) y")
    rows = rows.withColumn("h", F.xxhash64("x", "y"))
    some = rows.where("hash(x) % 3 = 0")
    contexts = some.select(F.concat_ws(" ", "x", "y").alias("context"))
    possible = pii._possible(rows, contexts)
    assert some.join(possible, ["x", "y"], "left_anti").count() == 0
    assert possible.count() < some.count() + 200
    monkeypatch.setattr(pii, "BROADCAST_PATTERNS", 10)
    assert pii._possible(rows, contexts).count() == 3000


def test_scores_by_hand(make):
    patterns = make("kind string, context string, seeds long", ("email", "a b", 8), ("email", "c d", 1))
    followers = make("context string, value string, n long", ("a b", None, 8), ("a b", "v", 2), ("c d", "v", 1), ("c d", None, 8))
    sure, instances = pii.score(patterns, followers, rounds=1)
    first = 1 - (1 - 8 / 10) * (1 - 1 / 9)
    assert instances.first()["sure"] == pytest.approx(first)
    got = {r["context"]: r["sure"] for r in sure.collect()}
    assert got == {"a b": pytest.approx((8 + 2 * first) / 10), "c d": pytest.approx((1 + first) / 9)}


def test_hard_rows(hard_docs, hard_rows):
    assert pii.find(hard_docs).count() == len(hard_rows)


def test_nothing(no_docs):
    assert pii.find(no_docs).count() == 0
