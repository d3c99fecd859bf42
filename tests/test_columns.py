import random
import re

import pytest
from pyspark.sql import functions as F

from basketry.functions.columns import lenient_double, lenient_int, ratio4

INTS = {
    "8": 8,
    " 8": 8,
    "\t8": 8,
    "8\n": 8,
    "+7": 7,
    "-7": -7,
    "007": 7,
    "3.7": 3,
    "-3.9": -3,
    "10.0": 10,
    "5.": 5,
    ".5": 0,
    "-.5": 0,
    "\t3.7": 3,
    "2147483647": 2147483647,
    "2147483647.9": 2147483647,
    "2147483648": None,
    "-2147483648": -2147483648,
    "-2147483649": None,
    "": None,
    "abc": None,
    "n/a": None,
    "1e2": None,
    "1d": None,
    "0x1": None,
    "NaN": None,
    "Infinity": None,
    "1.2.3": None,
    "--1": None,
    "1-": None,
    "1_0": None,
    "1 0": None,
    "٣": None,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_lenient_int(spark, make, ansi):
    table = make("v string", *((v,) for v in [*INTS, None]))
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = {r.v: r.i for r in table.select("v", lenient_int(F.col("v")).alias("i")).collect()}
        assert got == {**INTS, None: None}
        # The values are those of a cast that gives NULL instead of an error.
        if ansi == "false":
            plain = table.select("v", F.col("v").cast("int").alias("i")).collect()
            assert got == {r.v: r.i for r in plain}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_lenient_double(make):
    values = {
        "7": 7.0,
        " 7.5": 7.5,
        "1e2": 100.0,
        "-.5": -0.5,
        "abc": None,
        "": None,
        "a1": None,
        "Infinity": float("inf"),
        "-inf": float("-inf"),
    }
    table = make("v string", *((v,) for v in [*values, None]))
    got = {r.v: r.d for r in table.select("v", lenient_double(F.col("v")).alias("d")).collect()}
    assert got == {**values, None: None}


def test_casts_equal_a_lenient_cast_on_random_text(spark, make):
    rng = random.Random(3)
    pieces = ["0", "1", "7", "9", "123456789", "+", "-", ".", "e", "E", "d", "x", " ", "\t", "NaN"]
    texts = {"".join(rng.choices(pieces, k=rng.randrange(1, 6))) for _ in range(4000)}
    table = make("v string", *((v,) for v in texts))
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        rows = table.select(
            "v",
            lenient_int(F.col("v")).alias("i"),
            F.col("v").cast("int").alias("lenient_i"),
            lenient_double(F.col("v")).cast("string").alias("d"),
            F.col("v").cast("double").cast("string").alias("lenient_d"),
        ).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    lone_point = re.compile(r"\s*[+-]?[.]\s*")
    wrong = [r for r in rows if r.i != r.lenient_i and not lone_point.fullmatch(r.v)]
    assert wrong == []
    assert [r for r in rows if r.d != r.lenient_d] == []
    assert sum(r.i is not None for r in rows) > 150


def test_ratio4(make):
    table = make("a bigint, b bigint", (1, 3), (1, 80000), (1, 0), (None, 2), (2, 3))
    got = [r.r for r in table.select(ratio4(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got == [0.3333, 0.0, None, None, 0.6667]
    halves = make("a bigint, b bigint", (1, 20000), (3, 20000))
    got = [r.r for r in halves.select(ratio4(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got == [0.0001, 0.0002]
