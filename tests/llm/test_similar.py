from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from basketry.llm import similar

from .conftest import prose


def shingles(text: str) -> set[str]:
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a: str, b: str) -> float:
    one, other = shingles(a), shingles(b)
    return len(one & other) / len(one | other) if one | other else 1.0


def changed(text: str, draw: random.Random, share: float) -> str:
    """The text with some words replaced, one in a row each."""
    words = text.split()
    for i in draw.sample(range(len(words)), max(1, int(share * len(words)))):
        words[i] = f"other{draw.randint(0, 10**9)}"
    return " ".join(words)


def planted(seed: int, groups: int) -> tuple[list[tuple[int, str]], list[tuple[int, int, float]]]:
    """Texts and near copies of them at different similarities; (original, copy, similarity)."""
    draw, rows, pairs = random.Random(seed), [], []
    for i in range(groups):
        text = prose(1000 * seed + i, draw.randint(60, 400))
        rows.append((2 * i, text))
        copy = changed(text, draw, draw.choice([0.004, 0.01, 0.02, 0.04, 0.08]))
        rows.append((2 * i + 1, copy))
        pairs.append((2 * i, 2 * i + 1, jaccard(text, copy)))
    return rows, pairs


def test_near_copies_are_caught_and_others_left(spark):
    rows, pairs = planted(3, 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in similar.groups(docs).collect()}
    near = [(a, b) for a, b, s in pairs if s >= 0.8]
    assert len(near) > 150
    caught = sum(found[b] == a for a, b in near)
    assert caught >= 0.95 * len(near)
    # What is no match is never one: the shingles decide.
    assert all(found[b] == b for a, b, s in pairs if s < 0.8)
    assert all(found[a] == a for a, _, _ in pairs)


def test_a_stage_of_the_pipeline_drops_the_copies(spark):
    rows, pairs = planted(4, 100)
    docs = spark.createDataFrame([(i, t, "en", None, len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.one_of_each_group(spark, docs, "/nowhere")
    assert kept.columns == docs.columns
    left = {r["doc_id"] for r in kept.collect()}
    near = {b for _, b, s in pairs if s >= 0.8}
    assert len(left & near) <= 0.05 * len(near) + 1
    assert {i for i, _ in rows} - near <= left


def test_a_large_group_and_one_beside_it(spark):
    draw = random.Random(5)
    base, other = prose(1, 300), prose(2, 300)
    rows = [(i, changed(base, draw, 0.01)) for i in range(0, 600, 2)] + [(i, changed(other, draw, 0.01)) for i in range(1, 200, 2)]
    rows += [(1000, base), (1001, base), (1001, base), (2000, prose(3, 300))]
    found = similar.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"] % 2 if r["doc_id"] < 1000 else r["doc_id"], r["component_id"]) for r in found} == {
        (0, 0), (1, 1), (1000, 0), (1001, 0), (2000, 2000),
    }
    assert [r["doc_id"] for r in found if r["keeps"]].count(0) == 1


@pytest.mark.parametrize("similarity", [0.8, 0.9])
def test_distances_are_as_expected(similarity):
    draw = np.random.default_rng(1)
    distances = []
    for _ in range(200):
        n = 300
        both = round(2 * n * similarity / (1 + similarity))
        shared, *own = (draw.integers(0, 1 << 63, k).astype("<u8") for k in (both, n - both, n - both))
        one, other = (np.frombuffer(similar.fingerprint(np.concatenate([shared, o])), np.uint8) for o in own)
        distances.append(int(np.bitwise_count(one ^ other).sum()))
    assert abs(np.mean(distances) / similar.BITS - similar.differing(similarity)) < 0.01
    assert np.mean(np.array(distances) <= similar.radius(similarity)) >= 0.99


def test_hard_rows(spark, hard_docs, hard_rows, no_docs):
    got = similar.one_of_each_group(hard_docs)
    assert got.columns == hard_docs.columns
    ids = [r["doc_id"] for r in got.collect()]
    # 2 is a copy of 1; all texts without words are one group.
    assert sorted(i for i in ids if i is not None) == [1, 3, 4, 7, 8, 10, 11] and ids.count(None) == 1
    rows = similar.groups(hard_docs).collect()
    assert len(rows) == len(hard_rows)
    assert {r["component_id"] for r in rows if r["doc_id"] in (4, 5, 6)} == {4}
    assert similar.groups(no_docs).collect() == []


def test_no_pair_that_meets_the_threshold_is_left_out(spark, monkeypatch):
    rows, pairs = planted(3, 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in similar.groups(docs).collect()}
    assert found == {i: i for i, _ in rows} | {b: a for a, b, s in pairs if s >= 0.8}
    # Neither if the fingerprints find nothing.
    monkeypatch.setattr(similar, "radius", lambda similarity: -1)
    assert found == {r["doc_id"]: r["component_id"] for r in similar.groups(docs).collect()}


def test_a_text_is_linked_by_one_that_matched_a_pivot(spark):
    """40 texts near a pivot, and one that is only similar to one of them."""
    base = [f"w{i}" for i in range(400)]

    def text(*changed: int) -> str:
        return " ".join(f"x{i}" if i in changed else w for i, w in enumerate(base))

    # A change costs five shingles of 396.
    near = tuple(range(5, 40, 5))
    rows = [(0, text()), *[(i, text(380 - i)) for i in range(1, 40)], (50, text(*near)), (60, text(*near, *range(45, 80, 5)))]
    assert jaccard(rows[0][1], rows[-1][1]) < 0.8 <= min(jaccard(rows[0][1], rows[-2][1]), jaccard(rows[-2][1], rows[-1][1]))
    found = similar.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["component_id"] for r in found} == {0}


def test_parities_never_differ_in_more_classes_than_shingles():
    draw = np.random.default_rng(2)
    for n, m, both in [(10, 12, 8), (255, 257, 250), (300, 600, 300), (4000, 4100, 3600), (0, 3, 0), (5, 5, 5)]:
        shared, one, other = (draw.integers(0, 1 << 63, k).astype("<u8") for k in (both, n - both, m - both))
        prints = [similar.parities(np.unique(np.concatenate([shared, x]))) for x in (one, other)]
        found = similar.odd_differences([prints[0]] * 2, [prints[1]] * 2)
        apart = n + m - 2 * both
        assert found[0] == found[1] <= apart and found[0] % 2 == apart % 2
        assert found[0] >= 0.6 * apart or apart < 20


def nodes_of(spark, texts: list[str]):
    rows = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, text_key long")
    return similar.fingerprints(rows, 5, 0.8).withColumnRenamed("doc_id", "node").localCheckpoint()


def test_texts_of_their_own_that_share_a_passage_make_no_pairs(spark):
    draw = random.Random(8)
    common = " ".join(f"c{i}" for i in range(60))
    texts = [" ".join([common, *(f"w{k}x{i}" for i in range(draw.randint(200, 1500)))]) for k in range(60)]
    none = spark.createDataFrame([], "node long, root long")
    assert similar._met_in_prefixes(nodes_of(spark, texts), none, 0.8).count() == 0


def test_pairs_at_the_threshold_meet_in_prefixes(spark):
    """Texts of any size that are just as similar as they must be, beside others that share parts of them."""
    draw = random.Random(9)
    texts = []
    for k in range(150):
        base = [f"w{k % 40}x{i}" for i in range(draw.choice([6, 9, 20, 45, 120, 400]))]
        cut, more = draw.randint(0, len(base) // 8), draw.randint(0, len(base) // 8)
        texts += [" ".join(base), " ".join([*base[cut:], *(f"y{k}x{i}" for i in range(more))])]
    texts = sorted(set(texts))
    none = spark.createDataFrame([], "node long, root long")
    met = {(r["pivot"], r["node"]) for r in similar._met_in_prefixes(nodes_of(spark, texts), none, 0.8).collect()}
    sets = [shingles(t) for t in texts]
    want = {(a, b) for b in range(len(texts)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(want) > 60
    assert want <= met


@pytest.mark.parametrize("order", ["all", "half", "none"])
def test_pairs_at_the_threshold_meet_in_any_order(spark, order):
    draw = random.Random(11)
    texts = []
    for k in range(120):
        base = [f"w{k % 30}x{i}" for i in range(draw.choice([6, 20, 45, 120, 400]))]
        cut, more = draw.randint(0, len(base) // 8), draw.randint(0, len(base) // 8)
        texts += [" ".join(base), " ".join([*base[cut:], *(f"y{k}x{i}" for i in range(more))])]
    texts = sorted(set(texts))
    every = np.unique(np.concatenate([similar.shingles(t.encode(), 5) for t in texts]))
    frequent = {"all": every, "half": every[np.random.default_rng(1).random(len(every)) < 0.5], "none": every[:0]}[order]
    rows = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, text_key long")
    nodes = similar.fingerprints(rows, 5, 0.8, frequent).withColumnRenamed("doc_id", "node").localCheckpoint()
    none = spark.createDataFrame([], "node long, root long")
    met = {(r["pivot"], r["node"]) for r in similar._met_in_prefixes(nodes, none, 0.8).collect()}
    sets = [shingles(t) for t in texts]
    want = {(a, b) for b in range(len(texts)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert len(want) > 50
    assert want <= met


def test_a_crowd_of_distant_copies_makes_no_pairs_of_its_members(spark, monkeypatch):
    """Copies that each changed by themselves: less similar than 0.8, but all share shingles of the original."""
    monkeypatch.setattr(similar, "SAMPLED", 2, raising=False)
    counts, found = [], similar._met_in_prefixes

    def counted(*given):
        met = found(*given)
        counts.append(met.count())
        return met

    monkeypatch.setattr(similar, "_met_in_prefixes", counted)
    draw, base = random.Random(12), prose(7, 400)
    texts = [changed(base, draw, 0.06) for _ in range(200)]
    near = [changed(t, draw, 0.004) for t in texts[:20]]
    assert max(jaccard(a, b) for a in texts[:20] for b in texts[20:40]) < 0.8 <= min(map(jaccard, texts, near))
    docs = spark.createDataFrame(list(enumerate(texts + near)), "doc_id long, text string")
    groups = {r["doc_id"]: r["component_id"] for r in similar.groups(docs).collect()}
    assert groups == {i: i if i < 200 else i - 200 for i in range(220)}
    assert counts[0] <= 220
