"""Every registered query against its SQL, at the smallest scale."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check import connect, rows_of
from queries.registry import ENTRIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 6000 and "TotalAmount" in df.columns


def test_every_query_has_its_sql():
    assert set(ENTRIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, SF_DIR)
    answer = oracle.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, answer.fetchall())
