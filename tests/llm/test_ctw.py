import binascii
import math
import random
from collections import Counter

import numpy as np
import pytest

from basketry.llm import ctw
from basketry.llm.queries import op4_context_tree

from .conftest import prose

SF = "/root/testdata/sf0.001"


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def test_word_scores_of_the_registered_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    counts = Counter()
    for key, text in docs.items():
        if binascii.crc32(str(key).encode()) % 10:
            counts.update(tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    got = op4_context_tree(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        own = tokens(docs[r.doc_id])
        want = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        assert (r.n_tokens, r.train_tokens) == (len(own), total)
        assert r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 10 == 0)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        assert r.base_score == pytest.approx(want, rel=1e-9)
    held = [r for r in got if r.held_out and r.n_bytes > 200]
    bits = -sum(r.score for r in held) * math.log2(10) / sum(r.n_bytes for r in held)
    assert bits < 2.8  # a byte of these texts has over four bits by its own frequency


def kt(zeros, ones):
    p, a, b = 1.0, 0, 0
    for bit in [0] * int(zeros) + [1] * int(ones):
        p *= ((b if bit else a) + 0.5) / (a + b + 1)
        a, b = a + (not bit), b + bit
    return p


def test_kt_by_hand():
    pairs = [(0, 0), (1, 0), (3, 2), (7, 7), (0, 12)]
    got = ctw.log_kt(*(np.array(x, float) for x in zip(*pairs, strict=True)))
    assert got == pytest.approx([math.log(kt(*p)) for p in pairs], abs=1e-9)


def plain_tree(training, least, depth=ctw.DEPTH):
    """Counts of kept nodes, and the probability of a next bit by the recursive definition."""
    counts = {}
    for text in training:
        padded = bytes(depth) + text
        for i in range(depth, len(padded)):
            for d in range(depth + 1):
                for bit in range(8):
                    node = (padded[i - d : i], (1 << bit) | (padded[i] >> (8 - bit)))
                    counts.setdefault(node, [0, 0])[padded[i] >> (7 - bit) & 1] += 1
    kept = {n: c for n, c in counts.items() if sum(c) >= least}
    children = {}
    for context, node in kept:
        if context:
            children.setdefault((context[1:], node), []).append((context, node))

    def rest(n):
        return [kept[n][i] - sum(kept[c][i] for c in children.get(n, [])) for i in (0, 1)]

    def weighted(n):
        own = kt(*kept[n])
        if len(n[0]) == depth:
            return own
        below = kt(*rest(n))
        for c in children.get(n, []):
            below *= weighted(c)
        return (own + below) / 2

    def one(n, history):
        a, b = kept[n]
        estimate = (b + 0.5) / (a + b + 1)
        if len(n[0]) == depth:
            return estimate
        weight = kt(a, b) / 2 / weighted(n)
        child = (history[len(history) - len(n[0]) - 1 :], n[1])
        if child in kept:
            below = one(child, history)
        else:
            r = rest(n)
            below = (r[1] + 0.5) / (sum(r) + 1)
        return weight * estimate + (1 - weight) * below

    def log10(text):
        total, padded = 0.0, bytes(depth) + text
        for i in range(depth, len(padded)):
            for bit in range(8):
                node = (b"", (1 << bit) | (padded[i] >> (8 - bit)))
                p = one(node, padded[i - depth : i]) if node in kept else 0.5
                total += math.log10(p if padded[i] >> (7 - bit) & 1 else 1 - p)
        return total

    return log10


@pytest.mark.parametrize("capacity", [1, 30, ctw.CAPACITY])
def test_scores_equal_the_recursive_definition(spark, monkeypatch, capacity):
    monkeypatch.setattr(ctw, "CAPACITY", capacity)
    training = ["abracadabra", "abacus", "é b\n"]
    texts = ["abra", "xyz", "", "cadé"]
    size = sum(len(t.encode()) for t in training)
    plain = plain_tree([t.encode() for t in training], max(2, math.ceil(size / capacity)))
    rows = [(i, t, False) for i, t in enumerate(training)] + [(10 + i, t, True) for i, t in enumerate(texts)]
    got = {r.doc_id: r.score for r in ctw.score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")).collect()}
    for i, text, _ in rows:
        assert got[i] == pytest.approx(plain(text.encode()), rel=1e-6, abs=1e-9)


def test_probabilities_of_the_next_byte_sum_to_one(monkeypatch):
    draw = random.Random(3)
    data = bytes(draw.choices(b"abc de", k=400))
    levels = []
    for d in range(ctw.DEPTH + 1):
        counts = Counter()
        for i in range(ctw.DEPTH, len(data)):
            for bit in range(8):
                key = int.from_bytes(data[i - d : i], "little") << 8 | (1 << bit) | (data[i] >> (8 - bit))
                counts[key, data[i] >> (7 - bit) & 1] += 1
        keys = sorted({k for k, _ in counts})
        levels.append(tuple(np.array(x) for x in (keys, [counts[k, 0] for k in keys], [counts[k, 1] for k in keys])))
    tree = ctw.Tree(levels)
    for context in (b"abcde", b"zzzzz", b" de a"):
        code = (int.from_bytes(context, "little") << 8) + np.arange(256)
        assert (10 ** tree.log10(code)).sum() == pytest.approx(1)
        monkeypatch.setattr(ctw, "_SLOT_BITS", 3)
        tree.slots = None
        again = np.concatenate([code, code[::-1]])
        assert tree.remembered(again) == pytest.approx(tree.log10(again))


def test_a_long_text_is_scored_in_chunks(spark, monkeypatch):
    rows = [(i, prose(i, 300), i % 2 == 0) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").coalesce(1)
    whole = sorted((r.doc_id, r.score) for r in ctw.score(docs).collect())
    texts = [t.encode() for _, t, _ in rows]
    small = ctw.grams(bytes(ctw.DEPTH) + texts[0])
    monkeypatch.setattr(ctw, "_CHUNK", 97)
    parts = [ctw.grams(data)[ctw._own_places(p)] for p, data in ctw._chunks(texts[:1])]
    assert np.array_equal(np.concatenate(parts), small)
    assert whole[0][1] < 0


def test_hard_rows(hard_docs, hard_rows):
    docs = hard_docs.withColumn("learn", hard_docs["doc_id"] % 2 == 0)
    rows = ctw.score(docs, "learn").collect()
    assert len(rows) == len(hard_rows)
    for r in rows:
        if r.n_bytes == 0:
            assert (r.n_tokens, r.score, r.bits_per_byte) == (1, 0.0, None)
        else:
            assert r.score < 0 and r.bits_per_byte > 0


def test_nothing_to_learn_from(no_docs, hard_docs, hard_rows):
    assert ctw.score(no_docs.withColumn("learn", no_docs["doc_id"] > 0), "learn").count() == 0
    rows = ctw.score(hard_docs.withColumn("learn", hard_docs["held_out"] == "x"), "learn").collect()
    assert len(rows) == len(hard_rows)
    assert all(r.bits_per_byte in (None, pytest.approx(8)) and r.n_known == 0 for r in rows)


@pytest.fixture(scope="module")
def large_corpus():
    """More than twice 131,072 bytes, with a sentence that is there twice."""
    filler = [prose(i % 7, 4000) for i in range(12)]
    return [(i, t, False) for i, t in enumerate([*filler, "Quartz jumps vexed.", "Quartz jumps vexed."])] + [(99, "Quartz jumps", True)]


@pytest.mark.parametrize("known", [0, 500, ctw.GRAMS])
def test_what_occurs_twice_has_nodes_in_a_corpus_of_any_size(spark, monkeypatch, large_corpus, known):
    monkeypatch.setattr(ctw, "GRAMS", known)
    texts = {i: t.encode() for i, t, _ in large_corpus}
    codes = {i: ctw.grams(bytes(ctw.DEPTH) + t) for i, t in texts.items()}
    seen = np.concatenate([codes[i] for i, _, held in large_corpus if not held])
    assert len(seen) > 2 * 131_072
    tree = ctw.Tree(ctw.levels(*np.unique(seen, return_counts=True), 2, 0, ctw.DEPTH))
    docs = spark.createDataFrame(large_corpus, "doc_id long, text string, held_out boolean")
    got = {r.doc_id: r.score for r in ctw.score(docs.repartition(3)).collect()}
    assert got == {i: pytest.approx(tree.remembered(c).sum(), rel=1e-9) for i, c in codes.items()}


def test_blocks_hold_whole_subtrees(spark, monkeypatch):
    monkeypatch.setattr(ctw, "_BLOCK", 8)
    code = np.sort(np.random.default_rng(1).integers(0, 1 << 10, 400) << 22)
    batch = ctw.pa.record_batch({"gram": code, "word": ctw.pa.nulls(len(code), ctw.pa.binary()), "n": np.ones(len(code), np.int64)})
    blocks = list(ctw._blocks(ctw._merged(iter([batch.slice(0, 150), batch.slice(150)]))))
    different, many = np.unique(code, return_counts=True)
    assert len(blocks) > 5
    assert np.array_equal(np.concatenate([c for c, _ in blocks]), different)
    assert np.array_equal(np.concatenate([n for _, n in blocks]), many)
    tops = [set((c >> 24).tolist()) for c, _ in blocks]
    assert sum(map(len, tops)) == len(set().union(*tops))
