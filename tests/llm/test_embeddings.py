import numpy as np
import pytest

from basketry.llm import embeddings
from basketry.llm.queries import op10_embeddings

SF = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, label int, node string, size string, key string"


def plainly(rows, threshold=0.93):
    """Links and components by comparing all vectors of a label."""
    usable = {}
    for key, vector, label in rows:
        if key is None or label is None or vector is None or any(x is None for x in vector):
            continue
        v = np.array(vector, np.float32).astype(float)
        if np.isfinite(v).all() and (norm := np.linalg.norm(v)) > 0:
            usable[key] = (label, v / norm)
    keys = sorted(usable)
    links, root = dict.fromkeys(keys, 0), {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            (la, va), (lb, vb) = usable[a], usable[b]
            if la == lb and len(va) == len(vb) and va @ vb >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {key: (links.get(key, 0), find(key) if key in root else key) for key, _, _ in rows}


def found(df):
    return {r.vec_id: (r.n_links, r.component_id) for r in df.collect()}


def test_registered_query_finds_planted_copies_and_nothing_else(spark, tmp_path):
    draw = np.random.default_rng(9)
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    for i, (_, vector, label) in enumerate(rows[:300]):
        v = np.array(vector) / np.linalg.norm(vector)
        other = draw.standard_normal(len(v))
        other = (other - other @ v * v) / np.linalg.norm(other - other @ v * v)
        cosine = draw.choice([1.0, 0.99, 0.95, 0.935, 0.925, 0.9])
        rows.append((10**6 + i, (cosine * v + np.sqrt(1 - cosine**2) * other).tolist(), label))
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    want, df = plainly(rows), op10_embeddings(spark, str(tmp_path))
    got = found(df)
    assert got.keys() == want.keys()
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values()) > 0
    assert all(r.kept == (r.vec_id == r.component_id) for r in df.collect())


@pytest.mark.parametrize("block", [embeddings.BLOCK, 7])
def test_groups_of_copies_and_near_copies(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    draw = np.random.default_rng(5)
    rows, n = [], 0
    for label in (1, 1, 2, None):
        centre = draw.standard_normal(16)
        for spread in [0.0] * 12 + [0.02] * 25 + [0.15] * 10:
            rows.append((n := n + 1, (centre + spread * draw.standard_normal(16)).tolist(), label))
    table = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)
    want, got = plainly(rows), found(embeddings.near_duplicates(table))
    total = sum(k for k, _ in want.values())
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(k for k, _ in got.values()) >= 0.98 * total > 0


def test_recall_at_the_threshold_follows_from_the_shape():
    for nodes in (1, 1000, 10**6, 10**12):
        signs, tables = embeddings.shape(nodes)
        agree = (1 - np.arccos(0.93) / np.pi) ** signs
        assert 1 - (1 - agree) ** tables >= embeddings.RECALL


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1),
        (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 0.0], 1), (10, [1.0, None], 1), (11, [1.0, 0.0, 0.0], 1),
        (12, [1e-38, 0.0], 1), (13, [3e38, 0.0], 1), (14, [-1.0, 0.0], 1), (15, [1.0, 0.0], 2),
    ]
    table = spark.createDataFrame([(*r, "x", "x", "x") for r in [*rows, rows[0], (None, [1.0, 0.0], 1)]], SCHEMA)
    df = embeddings.near_duplicates(table)
    assert df.count() == len(rows) + 2
    got = found(df)
    assert got.pop(None) == (0, None)
    assert got == plainly(rows)


def test_nothing(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert embeddings.near_duplicates(table).count() == 0
