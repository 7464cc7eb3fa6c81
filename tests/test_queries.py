"""Every registered query on the smallest tables, against its SQL where there is one."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, duck
from checks.queries import NO_SQL, QUERIES

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(TABLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    good, note = compare(spark, con, TABLES, name)
    assert good, note


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(contract.oracle_sql()) & (set(QUERIES) | NO_SQL) == set(QUERIES) - NO_SQL


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "store_number",
        "category_name",
        "srl_num",
        "Date",
        "forecast_volume",
        "fc_sales",
    ]
    assert df.count() > 0 and df.count() % 18 == 0
