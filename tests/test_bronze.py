import pytest

from basketry.contracts import ENTITIES, contract
from basketry.operators.bronze import to_bronze
from basketry.sources.raw import RFC4180, scan_csv

HEADER = "product_id,product_name,aisle_id,department_id\n"


def csv_products(spark, tmp_path, text, *dialect):
    file = tmp_path / "products.csv"
    file.write_text(text)
    return scan_csv(spark, str(file), *dialect)


@pytest.mark.parametrize("entity", ENTITIES)
def test_columns_and_types(spark, make, entity, batch_time):
    columns = ENTITIES[entity].columns
    raw = make(", ".join(f"{c} string" for c in columns), tuple("1" for _ in columns))
    bronze = to_bronze(raw, entity, "2026-04-02", batch_time)
    expected = contract("bronze", entity)
    assert [(f.name, f.dataType) for f in bronze.schema] == [
        (f.name, f.dataType) for f in expected
    ]
    row = bronze.first()
    assert row.raw_ingestion_date == "2026-04-02"
    assert row.bronze_processed_at == batch_time


def test_blank_row_stays_and_empty_row_goes(spark, tmp_path):
    raw = csv_products(spark, tmp_path, HEADER + "   ,  ,,\n,,,\n7, x ,8,9\n")
    rows = to_bronze(raw, "products", "d").select(*ENTITIES["products"].columns).collect()
    assert [tuple(r) for r in rows] == [(None, "", None, None), (7, "x", 8, 9)]


def test_junk_row_stays_with_nulls(make):
    raw = make("aisle_id string, aisle string", ("abc", None), ("3.7", " a "), (None, None))
    rows = to_bronze(raw, "aisles", "d").select("aisle_id", "aisle").collect()
    assert [tuple(r) for r in rows] == [(None, None), (3, "a")]


def test_trim_takes_spaces_only(make):
    raw = make("aisle_id string, aisle string", ("1", " \ta\t "))
    assert to_bronze(raw, "aisles", "d").first().aisle == "\ta\t"


def test_default_dialect_splits_at_doubled_quotes(spark, tmp_path):
    raw = csv_products(spark, tmp_path, HEADER + '1,"a ""b"", c",2,3\n2,plain,4,5\n')
    rows = raw.collect()
    assert rows[0].product_name != 'a "b", c'
    assert tuple(rows[1]) == ("2", "plain", "4", "5")


def test_rfc4180_dialect(spark, tmp_path):
    text = HEADER + '1,"a ""b"", c",2,3\n3,"two\nlines",4,5\n'
    assert csv_products(spark, tmp_path, text).count() == 3
    rows = csv_products(spark, tmp_path, text, RFC4180).collect()
    assert [r.product_name for r in rows] == ['a "b", c', "two\nlines"]


def test_short_and_long_rows(spark, tmp_path):
    rows = csv_products(spark, tmp_path, HEADER + "1,a\n2,b,3,4,5\n").collect()
    assert [tuple(r) for r in rows] == [("1", "a", None, None), ("2", "b", "3", "4")]


def test_source_file_is_recorded(spark, tmp_path):
    from basketry.sources.raw import read_raw

    folder = tmp_path / "products" / "ingestion_date=2026-04-02"
    folder.mkdir(parents=True)
    (folder / "products.csv").write_text(HEADER + "1,a,2,3\n")
    raw, label = read_raw(spark, str(tmp_path), "products")
    assert to_bronze(raw, "products", label).first().source_file_name.endswith(
        "ingestion_date=2026-04-02/products.csv"
    )
