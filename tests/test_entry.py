"""Every registered query against its SQL, at the smallest scale."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_module
from workload.queries import QUERIES as OWN

SF = "/root/testdata/sf0.001"
QUERIES, SQL = {name: entry_module.queries()[name] for name in OWN}, entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    order = sorted(result.columns)
    relation = duck.sql(SQL[name])
    assert sorted(relation.columns) == order
    expected = relation.project(", ".join(f'"{c}"' for c in order)).fetchall()
    assert Counter(map(tuple, result.select(*order).collect())) == Counter(expected)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
