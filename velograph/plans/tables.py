"""Trips and edges taken from the order tables.

A trip is an order line: the part is the vehicle, the supplier's nation the start station, the
customer's nation the stop station. The trade graph has a node per customer (even ids) and per
supplier (odd ids) and at least one edge per order line, so it grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.sources import read_table

# Columns that tell two trips of one vehicle with equal start and stop time apart.
TRIP_TIE_BREAK = ("k1", "k2", "k3")


def rides(spark: SparkSession, folder: str) -> DataFrame:
    """Vehicle, duration and trip id of every trip; needs no other table than the order lines."""
    return read_table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("bike_id"),
        F.col("l_quantity").cast("int").alias("trip_duration"),
        F.col("l_orderkey").alias("trip_id"),
    )


def trips(
    spark: SparkSession, folder: str, bike_id: int | None = None, full: bool = False
) -> DataFrame:
    """Every trip with its times and stations, or those of one vehicle.

    ``full`` adds the columns from which the rest of a trip record is filled.
    """
    nation = read_table(spark, folder, "nation")
    start = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("start_station_name"))
    stop = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("stop_station_name"))
    lines = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders")
    customer = read_table(spark, folder, "customer")
    of_order, of_customer = F.col("l_orderkey") == F.col("o_orderkey"), F.col("o_custkey") == F.col("c_custkey")
    if bike_id is None:
        # Single tables are joined one by one: their sizes are known from the files, while that of a
        # joined pair is overestimated and would make the larger side the broadcast one.
        placed = lines.join(orders.join(customer, of_customer).join(stop, "c_nationkey"), of_order)
    else:
        # A vehicle's few order lines find their orders first, and only these their customers.
        placed = lines.filter(F.col("l_partkey") == bike_id).join(orders, of_order)
        placed = placed.join(customer, of_customer).join(stop, "c_nationkey")
    return (
        placed.join(read_table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(start, "s_nationkey")
        .select(
            F.col("l_partkey").alias("bike_id"),
            F.col("o_orderdate").alias("start_time"),
            F.col("l_shipdate").alias("stop_time"),
            F.col("l_quantity").cast("int").alias("trip_duration"),
            "start_station_name",
            "stop_station_name",
            F.col("l_orderkey").alias("k1"),
            F.col("l_linenumber").alias("k2"),
            F.col("l_suppkey").alias("k3"),
            *(["s_nationkey", "c_nationkey", "l_returnflag"] if full else []),
        )
    )


def _deals(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        read_table(spark, folder, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            (F.col("l_suppkey") * 2 + 1).alias("seller"),
            (F.col("o_custkey") * 2).alias("buyer"),
            F.col("l_quantity").cast("int").alias("weight"),
            (F.col("l_returnflag") == "R").alias("returned"),
        )
    )


def _edges(deals: DataFrame, back: Column) -> DataFrame:
    """An edge from seller to buyer per deal, and the reverse one where ``back`` holds."""
    there = F.struct(F.col("seller").alias("source"), F.col("buyer").alias("target"), "weight")
    back_again = F.struct(F.col("buyer").alias("source"), F.col("seller").alias("target"), "weight")
    return deals.select(F.inline(F.when(back, F.array(there, back_again)).otherwise(F.array(there))))


def flow_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Goods go from supplier to customer, returned ones also back. Directed, parallel edges kept."""
    return _edges(_deals(spark, folder), F.col("returned"))


def trade_edges(spark: SparkSession, folder: str) -> DataFrame:
    """Every deal as an edge in both directions, parallel edges kept."""
    return _edges(_deals(spark, folder), F.lit(True))
