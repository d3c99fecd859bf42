from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from basketry.llm import periodic, queries

SMALLEST = "/root/testdata/sf0.001"


def all_runs(words: list) -> list[tuple[int, int, int]]:
    """Every lag at every place, the smallest period of a stretch first."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def left(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    return " ".join(w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in runs))


def some_words(draw: random.Random) -> list[str]:
    alphabet = draw.choice([1, 2, 3, 5, 50, 1000])
    words = [str(draw.randint(0, alphabet)) for _ in range(draw.randint(0, 400))]
    for _ in range(draw.randint(0, 4)):
        block = [str(draw.randint(0, alphabet)) for _ in range(draw.randint(1, 90))]
        at, n = draw.randint(0, len(words)), int(len(block) * draw.uniform(2.5, 6))
        words[at:at] = [block[i % len(block)] for i in range(n)]
    return words


@pytest.mark.parametrize("seed", range(40))
def test_all_runs_of_random_texts_are_found(seed):
    draw = random.Random(seed)
    texts = [some_words(draw) for _ in range(8)]
    found = periodic._find([" ".join(words).encode() for words in texts])
    for words, (runs, kept) in zip(texts, found, strict=True):
        assert runs == all_runs(words)
        assert kept.decode() == left(words, runs)


@pytest.mark.parametrize("period", [1, 8, 9, 12, 13, 16, 17, 24, 25, 31, 32, 33, 48, 49, 64, 65, 96, 97, 500])
@pytest.mark.parametrize("more", [-1, 0, 1])
def test_runs_at_the_edges_of_scales_and_lengths(period, more):
    length = max(24, 3 * period) + more
    words = ["x"] + [f"w{i % period}" for i in range(length)] + ["y"]
    ((runs, _),) = periodic._find([" ".join(words).encode()])
    assert runs == ([(1, length, period)] if more >= 0 else [])


def test_a_run_does_not_go_on_in_the_next_text():
    part = " ".join(["a b c"] * 7).encode()  # 21 words
    assert [runs for runs, _ in periodic._find([part, part, b"", part])] == [[], [], [], []]


def test_a_long_text_of_one_word_and_one_of_a_long_period():
    words = [str(i) for i in range(30_000)]
    found = list(periodic._find([b"a " * 200_000, " ".join(words * 3).encode()]))
    assert found[0] == ([(0, 200_000, 1)], b"a")
    assert found[1] == ([(0, 90_000, 30_000)], " ".join(words).encode())


def test_hard_rows(hard_docs, hard_rows, no_docs):
    got = sorted(map(repr, ((r["doc_id"], r["kept_text"], r["runs"]) for r in periodic.find(hard_docs).collect())))
    assert got == sorted(repr((r[0], " ".join((r[1] or "").split()), [])) for r in hard_rows)
    assert periodic.find(no_docs).collect() == []


def expected(doc_id: int | None, text: str | None) -> tuple:
    words = [w.decode() for w in (text or "").encode().split()]
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = all_runs(words)
    best = max(runs, key=lambda r: (r[1] * 10**9 // r[2], -r[0], -r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, left(words, runs))]
    return doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, *digests


def test_the_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALLEST}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in queries.op11_periodic_runs(spark, SMALLEST).collect()}
    want = {r["doc_id"]: expected(r["doc_id"], r["text"]) for r in docs}
    assert got == want
    assert sum(w[1] > 0 for w in want.values()) > 10


def test_the_query_takes_hard_rows(spark, hard_docs, hard_rows, tmp_path):
    hard_docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op11_periodic_runs(spark, str(tmp_path)).collect()]
    short = [r for r in hard_rows if r[0] != 7]
    assert sorted(map(repr, (g for g in got if g[0] != 7))) == sorted(repr(expected(*r[:2])) for r in short)


def test_minima_of_windows():
    draw = np.random.default_rng(1)
    for width in range(1, 9):
        values = draw.integers(1, 9, 50).astype(np.uint64)
        windows = [range(i, i + width) for i in range(50 - width + 1)]
        want = {i for w in windows for i in w if values[i] == min(values[j] for j in w)}
        assert set(periodic._minima(values, width).tolist()) == want
