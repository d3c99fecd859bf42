"""Sources against landings line by line, and columns that drift."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.operators import drift, quality

LINES = "line string, source_file string, block long, row long"


def table(make, *rows):
    return make(LINES, *((line, f"file:/somewhere/{file}", block, i) for i, (line, file, block) in enumerate(rows)))


def told(df) -> set[tuple]:
    return {tuple(r) for r in df.collect()}


def test_equal_lines_in_any_order_and_blocks_do_not_differ(make):
    rows = [("a", "x", 0), ("b", "x", 0), ("b", "x", 50), ("", "y", 0), ("a", "y", 0)]
    other = make(LINES, *((r[0], f"viewfs://else/where/{r[1]}", 7, 9) for r in reversed(rows)))
    assert told(quality.content_differences(table(make, *rows), other)) == set()


def test_a_changed_line_names_its_block_though_the_counts_agree(make):
    source = table(make, ("h", "x", 0), ("a", "x", 0), ("b", "x", 50), ("c", "x", 50), ("z", "y", 0))
    raw = table(make, ("h", "x", 0), ("a", "x", 0), ("b?", "x", 40), ("c", "x", 40), ("z", "y", 0))
    assert told(quality.content_differences(source, raw)) == {("x", "source", 50, 1), ("x", "raw", 40, 1)}
    report = quality.content_report({"aisles": source}, {"aisles": raw}).first()
    assert (report.only_in_source, report.only_in_raw, report.differing_files, report.passed) == (1, 1, 1, False)
    assert report.differing_blocks == ["raw:x:40", "source:x:50"]
    same = quality.content_report({"aisles": source}, {"aisles": source}).first()
    assert same.passed and same.differing_blocks == []


def test_repeated_lines_count(make):
    source = table(make, *[("a", "x", 0)] * 3, *[("a", "x", 10)] * 2, ("b", "x", 0))
    raw = table(make, *[("a", "x", 0)] * 2, ("b", "x", 0))
    assert told(quality.content_differences(source, raw)) == {("x", "source", 10, 2), ("x", "source", 0, 1)}
    assert told(quality.content_differences(raw, source)) == {("x", "raw", 10, 2), ("x", "raw", 0, 1)}


def test_missing_files_and_empty_sides(make):
    source, none = table(make, ("a", "x", 0), ("b", "y", 0)), table(make)
    assert told(quality.content_differences(source, none)) == {("x", "source", 0, 1), ("y", "source", 0, 1)}
    assert told(quality.content_differences(none, none)) == set()
    lost = table(make, ("a", "x", 0), ("n", "new", 3))
    assert told(quality.content_differences(source, lost)) == {("y", "source", 0, 1), ("new", "raw", 3, 1)}


def test_random_sides(make):
    draw = random.Random(3)

    def side():
        return [(draw.choice("abcd"), draw.choice("xyz"), draw.choice([0, 10, 20])) for _ in range(120)]

    one, other = side(), side()
    got = told(quality.content_differences(table(make, *one), table(make, *other)))
    counts = [Counter((line, file) for line, file, _ in s) for s in (one, other)]
    for name, more in (("source", counts[0] - counts[1]), ("raw", counts[1] - counts[0])):
        want = Counter()
        for (_, file), n in more.items():
            want[file] += n
        found = Counter()
        for file, where, _, n in got:
            found[file] += n if where == name else 0
        assert +found == want


@pytest.fixture
def load(spark):
    draw = F.rand(7)
    return spark.range(20_000).select(
        F.col("id").alias("key"),
        (F.floor(draw * 24)).cast("int").alias("hour"),
        F.when(F.col("id") % 10 != 0, F.randn(5)).alias("days"),
        F.concat(F.lit("name "), F.col("id") % 300).alias("name"),
    )


def reasons(df) -> dict[str, str]:
    return {r.column_name: r.reasons for r in df.collect() if r.drifted}


def test_the_same_load_again_does_not_drift(spark, load, tmp_path):
    assert drift.follow(spark, load, f"{tmp_path}/h", "2026-01-01") is None
    again = drift.follow(spark, load, f"{tmp_path}/h", "2026-01-02")
    assert again.count() == 4 and reasons(again) == {}
    # More of the same doesn't either: keys grow with the rows, hours and names stay as many.
    more = load.unionByName(load.withColumn("key", F.col("key") + 20_000))
    assert reasons(drift.drift(drift.profile(load.select("hour", "name")), drift.profile(more.select("hour", "name")))) == {}


def test_what_changed_is_named(spark, load, tmp_path):
    drift.follow(spark, load, f"{tmp_path}/h", "2026-01-01")
    changes = {
        "hour": (F.floor(F.col("hour") / 3), "distribution,different"),
        "days": (F.col("days") + 1, "distribution"),
        "name": (F.when(F.col("key") % 5 != 0, F.col("name")), "nulls"),
        "key": (F.col("key") % 100, "distribution,different"),
    }
    for column, (change, reason) in changes.items():
        found = drift.follow(spark, load.withColumn(column, change), f"{tmp_path}/h", "2026-01-02")
        assert reasons(found) == {column: reason}
    other = load.drop("days").withColumn("fresh", F.lit(1))
    assert reasons(drift.follow(spark, other, f"{tmp_path}/h", "2026-01-02")) == {"days": "removed", "fresh": "added"}


def test_empty_loads_and_columns_without_values(spark, load, tmp_path):
    nothing = load.withColumn("days", F.lit(None).cast("double"))
    assert reasons(drift.drift(drift.profile(nothing), drift.profile(nothing))) == {}
    assert reasons(drift.drift(drift.profile(load), drift.profile(nothing))) == {"days": "nulls"}
    empty = drift.profile(load.limit(0))
    assert {r.row_count for r in empty.collect()} == {0}
    assert reasons(drift.drift(empty, empty)) == {}


def test_sketches_keep_their_bounds_and_merge(spark, load):
    whole = drift.profile(load)
    parts = [drift.profile(load.where(F.col("key") % 3 == i)) for i in range(3)]
    for profile in (whole, drift.merge_profiles(parts)):
        rows = {r.column_name: r for r in profile.select(
            "column_name", "row_count", "null_count", F.hll_sketch_estimate("different").alias("n"),
            F.kll_sketch_get_quantile_double("spread", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("cuts"),
        ).collect()}
        assert {r.row_count for r in rows.values()} == {20_000} and rows["days"].null_count == 2000
        assert abs(rows["key"].n / 20_000 - 1) < 0.05 and abs(rows["name"].n / 300 - 1) < 0.05 and rows["hour"].n == 24
        assert all(abs(cut / 20_000 - share) < 0.02 for cut, share in zip(rows["key"].cuts, (0.1, 0.5, 0.9), strict=True))
    found = drift.drift(whole, drift.merge_profiles(parts)).collect()
    assert all(r.rank_distance < 0.05 and r.different_factor < 1.05 for r in found)


def test_a_profile_is_filled_before_its_shuffle(load):
    df = drift.profile(load)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "partial_hll_sketch_agg" in text
