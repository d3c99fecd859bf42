import random

from basketry.llm.components import components


def expected(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {x: find(x) for x in parent}


def found(make, edges):
    rows = components(make("a long, b long", *edges)).collect()
    assert len(rows) == len({r["node"] for r in rows})
    return {r["node"]: r["root"] for r in rows}


def test_random_graphs(make):
    draw = random.Random(4)
    edges = [(draw.randrange(-60, 60), draw.randrange(-60, 60)) for _ in range(70)]
    assert found(make, edges) == expected(edges)


def test_a_chain_and_a_star(make):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(5, 5), (None, 7), (1, 0)]
    assert found(make, edges) == expected(edges)


def test_no_edges(make):
    assert found(make, []) == {}
