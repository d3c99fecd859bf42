import pytest
from pyspark.sql import functions as F

from basketry.contracts import ENTITIES
from basketry.operators import quality
from basketry.sources.snapshots import write_snapshot

AISLES = "aisle_id int, aisle string"
ITEM = "order_id int, product_id int"


def report_rows(df):
    return {r.check_name: (r.observed, r.passed) for r in df.collect()}


def test_contract_report(make):
    df = make("more int, aisle_id string", (1, "1"), (2, "2"))
    report = quality.contract_report(df, "raw", "aisles")
    assert report.columns == ["table_name", "check_name", "expected", "observed", "passed"]
    assert report_rows(report) == {
        "missing_columns": ("aisle", False),
        "unexpected_columns": ("more", True),
        "wrong_types": ("", True),
        "row_count": ("2", True),
    }
    with pytest.raises(ValueError, match="raw.aisles: missing_columns is 'aisle'"):
        quality.require(report)


def test_column_order_and_extras_do_not_fail(make):
    df = make("x int, aisle string, aisle_id string", (1, "a", "1"))
    quality.require(quality.contract_report(df, "raw", "aisles"))


def test_empty_table_fails(make):
    report = quality.contract_report(make("aisle_id string, aisle string"), "raw", "aisles")
    assert report_rows(report)["row_count"] == ("0", False)


@pytest.fixture
def bronze(make):
    return {
        "orders": make("order_id int", (1,), (1,), (1,), (2,), (None,), (None,)),
        "products": make(
            "product_id int, aisle_id int, department_id int", (1, 1, 1), (2, 5, None), (3, 5, 7)
        ),
        "aisles": make(AISLES, (1, "a"), (1, "b")),
        "departments": make("department_id int, department string", (1, "d")),
        "order_products_prior": make(ITEM, (1, 1), (1, 1), (1, 2), (8, 9), (8, 3), (None, 1)),
        "order_products_train": make(ITEM, (2, 1)),
    }


def test_key_duplicates(bronze):
    got = {
        r.table_name: (r.key_columns, r.duplicate_keys, r.surplus_rows)
        for r in quality.key_duplicates(bronze).collect()
    }
    assert got == {
        "orders": ("order_id", 1, 2),
        "products": ("product_id", 0, 0),
        "aisles": ("aisle_id", 1, 1),
        "departments": ("department_id", 0, 0),
        "order_products_prior": ("order_id,product_id", 1, 1),
        "order_products_train": ("order_id,product_id", 0, 0),
    }


def test_orphans(bronze):
    got = {
        (r.table_name, r.column_name): (r.referenced_table, r.orphan_ids, r.orphan_rows)
        for r in quality.orphans(bronze).collect()
    }
    assert got == {
        ("order_products_prior", "order_id"): ("orders", 1, 2),
        ("order_products_train", "order_id"): ("orders", 0, 0),
        ("order_products_prior", "product_id"): ("products", 1, 1),
        ("order_products_train", "product_id"): ("products", 0, 0),
        ("products", "aisle_id"): ("aisles", 1, 2),
        ("products", "department_id"): ("departments", 1, 1),
    }


def test_type_conformance(make):
    tables = {}
    for name, spec in ENTITIES.items():
        good = tuple(None if c == "eval_set" else "1" for c in spec.columns)
        bad = tuple("x" for _ in spec.columns)
        none = tuple(None for _ in spec.columns)
        tables[name] = make(", ".join(f"{c} string" for c in spec.columns), good, bad, none)
    rows = quality.type_conformance(tables).collect()
    assert {r.bad_values for r in rows} == {1}
    assert len(rows) == 19
    kinds = {(r.table_name, r.column_name): r.expected_type for r in rows}
    assert kinds[("orders", "days_since_prior_order")] == "double"
    assert ("products", "product_name") not in kinds


def test_types_are_part_of_the_contract(make):
    df = make("department_id string, department string", ("1", "a"))
    report = quality.contract_report(df, "bronze", "departments")
    assert report_rows(report)["wrong_types"] == ("department_id string", False)


def test_source_records_and_raw_counts(spark, tmp_path):
    (tmp_path / "parts").mkdir()
    (tmp_path / "parts" / "one").write_text('h,"h"\n1,"a, b"\n\n  \n2,b,c,d\n')
    (tmp_path / "parts" / "two").write_text("h,h\n")
    records = quality.source_records(spark, str(tmp_path / "parts"))
    assert records.first().source_rows == 2
    source = dict.fromkeys(ENTITIES, records)
    landed = dict.fromkeys(ENTITIES, spark.range(2)) | {"aisles": spark.range(1)}
    got = {
        r.entity: (r.source_rows, r.raw_rows, r.passed)
        for r in quality.source_raw_counts(source, landed).collect()
    }
    assert got == {e: (2, 2, True) for e in ENTITIES} | {"aisles": (2, 1, False)}


def test_snapshots_that_break_their_contract_are_named(spark, make, tmp_path):
    def check():
        return quality.validate_snapshot(spark, str(tmp_path), "bronze", "departments")

    with pytest.raises(FileNotFoundError, match="directory not found"):
        check()
    lineage = "source_file_name string, raw_ingestion_date string, bronze_processed_at timestamp"
    whole = make(f"department_id int, department string, {lineage}", (1, "a", "f", "d", None))
    root = f"{tmp_path}/departments"
    write_snapshot(whole, root, "2026-04-01")
    assert check().where("not passed").count() == 0
    broken = [
        (whole.drop("department"), "missing_columns is 'department'"),
        (whole.withColumn("department_id", F.lit("1")), "wrong_types is 'department_id string'"),
        (whole.limit(0), "row_count is '0'"),
    ]
    for day, (table, problem) in enumerate(broken, 2):
        write_snapshot(table, root, f"2026-04-0{day}")
        with pytest.raises(ValueError, match=problem):
            check()
    (tmp_path / "departments" / "ingestion_date=2026-05-01").mkdir()
    with pytest.raises(FileNotFoundError, match="no data files"):
        check()


def test_reports_are_appended(spark, make, tmp_path):
    table = make("aisle_id string, aisle string", ("1", "a"))
    report = quality.contract_report(table, "raw", "aisles")
    for label in ("a", "b"):
        quality.save_report(report, f"{tmp_path}/reports", label)
    stored = spark.read.parquet(f"{tmp_path}/reports")
    assert stored.count() == 8
    assert {r.run_label for r in stored.collect()} == {"a", "b"}
