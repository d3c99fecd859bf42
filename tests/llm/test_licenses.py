import random
import re
import time
from collections import Counter

import pytest

from basketry.llm import licenses
from basketry.llm.patience import align
from basketry.llm.queries import op7_licenses

from .conftest import prose

SF = "/root/testdata/sf0.01"


def notices(text, **more):
    return licenses.Scanner(licenses.TEMPLATES, more.get("coverage", licenses.COVERAGE)).scan(text)


def test_every_wording_is_found_whole_in_running_text():
    for license_id, wordings in licenses.TEMPLATES.items():
        for i, wording in enumerate(wordings):
            before = f"{prose(i, 300)} the of in and under work version"
            found = notices(f"{before}\n{wording.upper()}\n{prose(i + 50, 300)} and the by")
            n = len(licenses.word_list(before))
            assert (license_id, i, 1.0, n, n + len(licenses.word_list(wording))) in found


def test_changed_and_repeated_notices():
    text = licenses.TEMPLATES["Apache-2.0"][1]
    words = text.split(" ")
    words[3], words[12] = "odd", "other words here"
    found = [f for f in notices(f"{prose(1, 30)} {' '.join(words)} {prose(2, 40)} {text}") if f[:2] == ("Apache-2.0", 1)]
    assert len(found) == 2 and 0.8 <= found[0][2] < 1 and found[1][2] == 1
    half = " ".join(text.split(" ")[: len(words) // 2])
    assert not [f for f in notices(half) if f[:2] == ("Apache-2.0", 1)]


def test_scattered_words_are_no_notice():
    scattered = prose(3, 40).join(["Released ", " under ", " the ", " MIT ", " License"])
    assert notices(scattered) == []


def test_registered_query_against_plain_search(spark):
    """In these texts a notice is a line of its own, so that searching for it finds the same documents."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r["doc_id"]: {n["license"] for n in r["notices"] if n["coverage"] == 1} for r in op7_licenses(spark, SF).collect()}
    assert got.keys() == docs.keys()
    for key, text in docs.items():
        plain = " ".join(licenses.word_list(text))
        want = {
            name for name, wordings in licenses.TEMPLATES.items()
            if any(re.search(rf"(^| ){re.escape(' '.join(licenses.word_list(w)))}( |$)", plain) for w in wordings)
        }
        assert want <= got[key]
    assert sum(map(bool, got.values())) > 10


def common(a: list, b: list) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            row[j + 1], before = max(before + 1 if x == y else 0, row[j + 1], row[j]), row[j + 1]
    return row[-1]


def both_ways(text: str) -> int:
    """Every notice is one, and every window that aligns well enough has one; the number of notices."""
    words, found = licenses.word_list(text), notices(text)
    for license_id, wording, coverage, start, end in found:
        template = licenses.word_list(licenses.TEMPLATES[license_id][wording])
        assert coverage >= licenses.COVERAGE and end - start <= licenses.STRETCH * len(template)
        assert round(coverage * len(template)) <= common(template, words[start:end])
    for license_id, wordings in licenses.TEMPLATES.items():
        for i, wording in enumerate(wordings):
            template = licenses.word_list(wording)
            least, own = licenses.COVERAGE * len(template), Counter(template)
            spans = [(s, e) for name, k, _, s, e in found if (name, k) == (license_id, i)]
            for at in range(len(words) - int(least) + 1):
                window = words[at : at + len(template)]
                if window[0] not in own or (own & Counter(window)).total() < least:
                    continue
                aligned = align(template, window)
                if len(aligned) >= least - 1e-9:
                    first, last = at + aligned[0][1], at + aligned[-1][1] + 1
                    assert any(s < last and first < e for s, e in spans), (license_id, i, at)
    return len(found)


def damaged(text: str, draw: random.Random, share: float) -> str:
    words = text.split()
    for at in draw.sample(range(len(words)), int(share * len(words))):
        words[at] = draw.choice(["", "zz", words[at] + " zz", words[draw.randrange(len(words))]])
    return " ".join(words)


@pytest.mark.parametrize("seed", range(6))
def test_damaged_notices_both_ways(seed):
    draw, found = random.Random(seed), 0
    every = [w for wordings in licenses.TEMPLATES.values() for w in wordings]
    for n in range(6):
        parts = [damaged(draw.choice(every), draw, draw.choice([0, 0.05, 0.1, 0.2, 0.4])) for _ in range(3)]
        found += both_ways(prose(seed * 10 + n, 30).join(["", *parts, ""]))
    assert found


def test_texts_of_the_table_both_ways(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("length(text) < 3000").collect()
    assert sum(both_ways(r.text) for r in docs) > 0


def test_whole_licenses_are_told_apart():
    for name, body in (("ISC", licenses._ISC), ("Zlib", licenses._ZLIB), ("Unlicense", licenses._UNLICENSE), ("MIT", licenses._MIT)):
        whole = {(f[0], f[2]) for f in notices(prose(1, 50) + body + prose(2, 50)) if len(licenses.TEMPLATES[f[0]][f[1]]) > 600}
        assert whole == {(name, 1.0)}
    bsd = {f[0]: f[2] for f in notices(licenses._BSD_START + licenses._BSD_END) if f[4] - f[3] > 100}
    assert bsd["BSD-2-Clause"] == 1 and 0.8 <= bsd["BSD-3-Clause"] < 1


def test_many_near_misses_take_bounded_time():
    words = licenses.word_list(licenses._MIT)
    draw = random.Random(1)
    text = " ".join(draw.choice(words) for _ in range(3000))
    start = time.perf_counter()
    notices(text)
    assert time.perf_counter() - start < 60


def test_hard_rows(hard_docs, hard_rows):
    rows = licenses.scan(hard_docs).collect()
    assert len(rows) == len(hard_rows) and all(r["notices"] == [] for r in rows)


def test_nothing(no_docs, hard_docs):
    assert licenses.scan(no_docs).count() == 0
    assert licenses.scan(hard_docs, templates={}).where("size(notices) > 0").count() == 0


def test_windows_without_enough_words_of_a_template_are_not_aligned(monkeypatch):
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    draw = random.Random(5)
    own = sorted(set(licenses.word_list(licenses.TEMPLATES["MIT"][-1])))
    # All its words, far apart, and a few of them over and over.
    text = " ".join(w for word in own for w in (word, *draw.choices(["the", "software", "or", "of", "and", "to"], k=6)))
    monkeypatch.setattr(licenses, "align", lambda a, b: pytest.fail("aligned in vain"))
    assert scanner.scan(text) == []


def test_words_in_common_by_counting_each_window():
    draw = random.Random(6)
    for _ in range(50):
        template = draw.choices(range(6), k=draw.randint(1, 12))
        text = [draw.choice([-1, *template]) for _ in range(80)]
        hits = [i for i, w in enumerate(text) if w >= 0]
        width = 2 * len(template)
        got = licenses.Scanner._common([text[i] for i in hits], hits, template, width)
        assert got == [sum((Counter(template) & Counter(text[i : i + width])).values()) for i in hits]
