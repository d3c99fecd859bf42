import random
from itertools import combinations

import xxhash
from pyspark.sql import functions as F

from basketry.llm import simhash
from basketry.llm.components import components
from basketry.llm.queries import op6_simhash

SF = "/root/testdata/sf0.001"


def plainly(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= 2:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {p: find(p) for p in prints}


def test_registered_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    prints = {i: plainly(t) for i, t in rows}
    root = groups(set(prints.values()))
    smallest = {}
    for i, p in prints.items():
        smallest[root[p]] = min(i, smallest.get(root[p], i))
    want = {i: (f"{p:016x}", smallest[root[p]]) for i, p in prints.items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in op6_simhash(spark, SF).collect()}
    assert got == want


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_dense_groups_keep_every_component(spark, monkeypatch):
    draw = random.Random(8)
    prints = set()
    for _ in range(4):
        centre = draw.getrandbits(64)
        for _ in range(60):  # chains of small steps away from a centre, and lone values
            centre ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 2, 3])))
            prints |= {centre, centre ^ (1 << draw.randrange(64)), draw.getrandbits(64)}
    table = spark.createDataFrame([(signed(p),) for p in prints], "print long")
    want = {p: r for p, r in groups(prints).items()}
    for pairwise in (simhash.PAIRWISE, 1):  # with 1, every key takes the way for many
        monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
        edges = simhash.links(table)
        ends = [((a % (1 << 64)), (b % (1 << 64))) for a, b in edges.collect()]
        assert all((a ^ b).bit_count() <= 2 for a, b in ends)
        got = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in components(edges).collect()}
        of = {}
        for p in prints:
            of.setdefault(got.get(p, p), set()).add(p)
        wanted = {}
        for p, r in want.items():
            wanted.setdefault(r, set()).add(p)
        assert sorted(map(sorted, of.values())) == sorted(map(sorted, wanted.values()))


def test_hard_rows(hard_docs, hard_rows):
    got = simhash.near_duplicates(hard_docs)
    assert got.count() == len(hard_rows)
    of = {}
    for r in got.collect():
        of.setdefault(r["doc_id"], set()).add((r["print"], r["component_id"]))
    assert of[1] == of[2] and {c for _, c in of[1]} == {1}
    # Empty, blank and NULL texts are one group of print 0; a row without an id may be in it.
    assert of[4] == of[5] == of[6] == {(0, 4)} and (0, 4) in of[None]


def test_one_row_of_each_group_stays(hard_docs):
    kept = simhash.one_of_each_group(hard_docs)
    assert kept.columns == hard_docs.columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())
    assert ids == [1, 3, 4, 7, 8, 10, 11]
    assert kept.where("doc_id is null").count() == 1  # the one with a text of its own


def test_nothing(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.one_of_each_group(no_docs).count() == 0
    assert simhash.links(no_docs.select(F.col("doc_id").alias("print"))).count() == 0
