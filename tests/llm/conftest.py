from __future__ import annotations

import random

import pytest

LONG_WORDS = 60_000
#: Columns of the caller that are called like columns inside the operators.
CLASHING = ["row", "key", "print", "text_key", "removed", "at", "count", "held_out", "score", "words", "spans", "odd name: <x>"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    parts = ["ba", "ke", "lo", "mi", "nu", "ra", "so", "ti", "vu", "ze", "st", "ing"]
    return " ".join("".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """Rows with NULLs, empty and blank texts, one very long text, copies, repeated rows and ties."""
    plain = [
        (1, prose(1, 80), "en"),
        (2, prose(1, 80), "en"),  # a copy
        (2, prose(1, 80), "en"),  # a repeated row
        (3, prose(3, 80), None),
        (4, "", "en"),
        (5, None, "en"),
        (6, " \n\t ", "en"),
        (7, prose(7, LONG_WORDS), "en"),
        (8, "1234 5678", "en"),
        (None, prose(9, 60), "en"),
        (None, None, None),
        (10, "aé\U0001f600 b", "en"),
        (11, prose(11, 40) + "\n" + prose(1, 80), "en"),
    ]
    return [(i, t, lang, None, None if t is None else len(t), *["x"] * len(CLASHING)) for i, t, lang in plain]


@pytest.fixture
def hard_docs(spark, hard_rows):
    return spark.createDataFrame(hard_rows, DOCS)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
