"""Every named query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from velograph.plans import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF}/{file}'")
    yield connection
    connection.close()


def in_name_order(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


def test_every_query_has_sql():
    assert QUERIES and set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    result = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert {c: TYPE_NAMES[t] for c, t in df.dtypes} == {c[0]: str(c[1]) for c in result.description}
    assert in_name_order(df.columns, df.collect()) == in_name_order(columns, result.fetchall())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["bike_id", "totalTime", "numTrips"]
    totals = [r.totalTime for r in df.collect()]
    assert len(totals) == 10 and totals == sorted(totals, reverse=True)


ORDER = {
    "station_trip_balance": lambda r: r["station"],
    "top_n_vehicles": lambda r: (-r["totalTime"], r["bike_id"]),
    "vehicle_relocations": lambda r: (r["start_time"], r["stop_time"]),
    "pagerank_in": lambda r: (-r["pagerank"], -r["id"]),
    "shortest_paths": lambda r: r["id"],
}


@pytest.mark.parametrize("name", ORDER)
def test_results_come_in_order(spark, name):
    """The order of the rows is part of the result; the comparison with SQL ignores it."""
    got = contract.queries()[name](spark, SF).collect()
    assert got == sorted(got, key=ORDER[name])
