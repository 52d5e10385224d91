"""Parquet tables, one file or folder per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns in use and their types. Declaring them saves looking into the files.
TABLE_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ"
    ),
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Read table ``name`` of ``folder``."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
