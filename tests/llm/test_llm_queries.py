"""The queries that SQL can express, against their SQL on the smallest tables."""

import os

import duckdb
import pytest

from velograph.llm import ORACLE_SQLS, QUERIES

SF = "/root/testdata/sf0.001"


def rows_in_order(columns, records):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(r[k] for k in order) for r in records), key=repr)


@pytest.mark.parametrize("name", ORACLE_SQLS)
def test_query_agrees_with_sql(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SF):
        duck.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE_SQLS[name])
    assert rows_in_order(df.columns, df.collect()) == rows_in_order([c[0] for c in result.description], result.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
