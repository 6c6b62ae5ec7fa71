"""Every registered query against its SQL on the same tables."""

import oracle
import pytest

import __spark_entry__ as entry
from workload import queries as registered

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return oracle.connect(FOLDER)


def test_every_layer_query_has_sql():
    assert set(registered.SQL) == set(registered.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    found = oracle.spark_rows(entry.queries()[name](spark, FOLDER))
    assert found == oracle.sql_rows(db, entry.oracle_sql()[name])


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 100 and {r["o_orderstatus"] for r in rows} == {"Open"}
