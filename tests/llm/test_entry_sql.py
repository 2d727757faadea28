"""The registered text queries against their SQL, at the smallest scale."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from logloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    order = sorted(result.columns)
    relation = duck.sql(ORACLE_SQL[name])
    assert sorted(relation.columns) == order
    expected = relation.project(", ".join(f'"{c}"' for c in order)).fetchall()
    assert Counter(map(tuple, result.select(*order).collect())) == Counter(expected)
