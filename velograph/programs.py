"""The five questions and the comparison, from a folder of text files to a result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from velograph import operators as op
from velograph.sources import (
    rank_listing_lines,
    read_edges,
    read_edges_strict,
    read_listing,
    read_trips,
)


def stations(spark: SparkSession, trip_folder: str) -> DataFrame:
    """Departures and arrivals per station."""
    return op.station_trip_balance(read_trips(spark, trip_folder))


def top_bikes(spark: SparkSession, trip_folder: str, top_n_bikes: int) -> DataFrame:
    """The bikes in use longest."""
    return op.top_n_vehicles(read_trips(spark, trip_folder), top_n_bikes)


def bike_moves(spark: SparkSession, trip_folder: str, bike_id: int) -> DataFrame:
    """Where and when a bike was moved between two trips."""
    return op.vehicle_relocations(read_trips(spark, trip_folder), bike_id)


def rank_lines(
    spark: SparkSession,
    edge_folder: str,
    reset_probability: float,
    max_iterations: int,
    direction: str = "in",
) -> DataFrame:
    """Listing of the nodes by PageRank, one ``line`` per node."""
    edges = read_edges_strict(spark, edge_folder)
    ranks = op.pagerank(edges, reset_probability, max_iterations, direction)
    return rank_listing_lines(op.rank_listing(ranks))


def paths_from(spark: SparkSession, edge_folder: str, source_node: int) -> DataFrame:
    """Cheapest path from a node to every other."""
    return op.shortest_paths(read_edges(spark, edge_folder), source_node)


def check(spark: SparkSession, expected_path: str, actual_path: str) -> DataFrame:
    """Compare two result listings line by line, white space ignored."""
    return op.diff_listings(read_listing(spark, expected_path), read_listing(spark, actual_path))
