"""Every registered query against its SQL, on the smallest tables."""

import re

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module
from basketry.plans import stored
from basketry.sources import paths

SF = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF)
    yield connection
    connection.close()


def test_every_query_of_the_library_has_an_oracle():
    on_text = {n for n in QUERIES if re.match(r"op[0-9]+_|pipeline$", n)}
    assert set(QUERIES) - on_text == set(ORACLES) - on_text
    assert not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, ORACLES[name]) == []


def test_a_second_call_writes_no_source(spark):
    before = stored.sources(spark, SF), stored.raw_root(spark, SF)
    made = len(paths._MADE)
    for name in ("src_manifest", "raw_landing", "scan_csv_orders", "dq_raw", "dq_source_raw_counts"):
        QUERIES[name](spark, SF)
    assert (stored.sources(spark, SF), stored.raw_root(spark, SF)) == before
    assert len(paths._MADE) == made


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[0] == "product_id"
    assert df.count() > 0
