from __future__ import annotations

import math

import numpy as np
import pytest
from compare import connect, differences

from basketry.llm import queries, vector_codes

SF = "/root/testdata/sf0.001"
ROWS = "vec_id long, embedding array<float>, label string, row string, trees string, vector string, code string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "a", "b", "c", "d") for i, v, label in rows], ROWS)


@pytest.mark.parametrize("seed", range(20))
def test_trees_give_what_comparing_all_gives(seed):
    draw = np.random.default_rng(seed)
    for _ in range(8):
        n, width, size = draw.integers(0, 300), draw.integers(1, 6), draw.choice([1, 3, 30, 1000, 1 << 24])
        rows = draw.integers(-size, size + 1, (n, width))
        entries = draw.integers(-size, size + 1, (draw.integers(1, 20), width))
        tree = vector_codes.CoverTree.load(vector_codes.build(rows).dump())
        all_pairs = ((rows[:, None] - entries[None]) ** 2).sum(2)
        codes, errors = vector_codes.code(tree, entries)
        nearest = all_pairs.argmin(1) if n else codes
        assert (codes == nearest).all() and (errors == (all_pairs.min(1) if n else errors)).all()
        total, count = vector_codes.gather(tree, entries)
        for k in range(len(entries)):
            assert (total[k] == rows[nearest == k].sum(0)).all() and count[k] == (nearest == k).sum()


def test_the_trees_keep_their_promises():
    rows = np.random.default_rng(5).integers(-200, 200, (500, 3))
    tree = vector_codes.build(np.concatenate([rows, rows[:50]]))
    below = [[] for _ in tree.point]
    for node in tree.leaf:
        at = node
        while at >= 0:
            below[at].append(tree.point[node])
            at = tree.parent[at]
    for i, (first, end) in enumerate(tree.children):
        away = np.sqrt(((np.array(below[i]) - tree.point[i]) ** 2).sum(1))
        assert math.isclose(away.max(), tree.radius[i]) and tree.count[i] == len(below[i])
        assert (tree.total[i] == np.sum(below[i], 0)).all()
        if first == end:
            assert tree.radius[i] == 0
            continue
        children = tree.point[first:end]
        assert (children[0] == tree.point[i]).all() and (tree.parent[first:end] == i).all()
        cover = 2 ** (math.ceil(math.log2(tree.radius[i])) - 1)
        gaps = np.sqrt(((children[:, None] - children[None]) ** 2).sum(2))
        assert (tree.radius[first:end] <= cover).all() and (gaps + np.eye(len(gaps)) * 1e9 > cover).all()


def test_whole_subtrees_are_assigned_at_once():
    draw = np.random.default_rng(1)
    middles = draw.integers(-5000, 5000, (10, 4))
    rows = middles[draw.integers(0, 10, 4000)] + draw.integers(-20, 20, (4000, 4))
    nodes, _ = vector_codes.assign(vector_codes.build(rows), middles)
    assert len(nodes) < 200


def by_hand(rows, parts=16, entries=64):
    """{(vec_id, vector): (code, error)}, errors by label and the codebooks, by comparing all with all."""
    kept = [(i, v, label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.floor(np.array([v for _, v, _ in kept], np.float32).astype(float) * 256).astype(int).reshape(len(kept), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        away = [((x[:, p, None] - books[p][None]) ** 2).sum(2) for p in range(parts)]
        return np.stack([a.argmin(1) for a in away], 1), sum(a.min(1) for a in away)

    for _ in range(2):
        codes, _ = nearest()
        for p in range(parts):
            for k in range(books.shape[1]):
                own = x[codes[:, p] == k, p]
                if len(own):
                    books[p, k] = own.sum(0) // len(own)
    codes, errors = nearest()
    out = sorted((str(i), str(label), codes[n].tolist(), int(errors[n])) for n, (i, _, label) in enumerate(kept))
    return out, books


def found(df):
    return sorted((str(r["vec_id"]), str(r["label"]), r["codes"], r["error"]) for r in df.collect())


@pytest.mark.parametrize("n", [1, 40, 700])
def test_small_tables_equal_brute_force(spark, n, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK", 100)
    draw = np.random.default_rng(n)
    rows = [(int(i), draw.normal(0, 0.1, 32).astype(np.float32).tolist(), "ab"[i % 2]) for i in draw.permutation(n)]
    rows += [(int(i) % 7, rows[i % n][1], None) for i in range(n // 3)]  # repeated ids and vectors, no label
    got, books = vector_codes.compress(table(spark, rows).repartition(3))
    want, own_books = by_hand(rows)
    assert found(got) == want and (books == own_books).all()
    sums = {}
    for _, label, _, error in want:
        sums[label] = sums.get(label, 0) + error
    assert {(str(r["label"]), r["label_error"]) for r in got.collect()} == set(sums.items())


def test_labels_joined_by_sorting(spark, monkeypatch):
    rows = [(i, [i / 7] * 16, None if i % 3 else "a") for i in range(30)]
    plain = vector_codes.compress(table(spark, rows))[0].collect()
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    assert sorted(map(repr, vector_codes.compress(table(spark, rows))[0].collect())) == sorted(map(repr, plain))


def test_hard_rows(spark):
    good = [(3, [0.5] * 16, "a"), (2, [0.25] * 16, None), (2, [0.25] * 16, None), (None, [9.0] * 16, "a")]
    bad = [
        (1, None, "a"), (1, [None] * 16, "a"), (1, [math.nan] * 16, "a"), (1, [math.inf] * 16, "a"),
        (1, [1.0] * 15, "a"), (4, [1.0] * 32, "a"),
    ]
    got, books = vector_codes.compress(table(spark, good + bad))
    want, own_books = by_hand(good)
    assert found(got) == want and (books == own_books).all()
    huge, _ = vector_codes.compress(table(spark, [(1, [3e38] * 16, "a"), (2, [-3e38] * 16, "a"), (3, [1.0] * 16, "a")]))
    assert {r["error"] for r in huge.collect()} == {0}
    none, _ = vector_codes.compress(table(spark, []))
    assert none.collect() == []
    empty, _ = vector_codes.compress(table(spark, [(1, [], "a"), (2, [], None)]))
    assert [(r["codes"], r["error"]) for r in empty.collect()] == [([0] * 16, 0)] * 2
    only_bad, _ = vector_codes.compress(table(spark, bad[:5]))
    assert only_bad.collect() == []


def test_a_sum_that_does_not_fit_is_null(spark, monkeypatch):
    rows = [(i, [float((-1) ** i * 60_000)] * 4096, "a") for i in range(2000)]
    monkeypatch.setattr(vector_codes, "ENTRIES", 1)
    got, _ = vector_codes.compress(table(spark, [(0, [0.0] * 4096, "a"), *[(i + 1, v, x) for i, v, x in rows]]))
    assert {r["label_error"] for r in got.collect()} == {None}


def test_the_query_equals_its_sql(spark):
    sql = queries.oracle_sql()["op12_vector_codes"]
    assert differences(queries.op12_vector_codes(spark, SF), connect(SF), sql) == []
