"""The named queries. Each takes a session and a folder of parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph import operators as op
from velograph.layout.lineage import cut_lineage, ensure_checkpoint_dir
from velograph.plans.tables import TRIP_TIE_BREAK, flow_edges, rides, trade_edges, trips
from velograph.sources import (
    rank_listing_lines,
    read_edges,
    read_edges_strict,
    read_listing,
    read_trips,
    row_listing,
    write_listing,
)

Query = Callable[[SparkSession, str], DataFrame]

TOP_N = 10
VEHICLE = 42
START_NODE = 1
RESET_PROBABILITY = 0.15
ITERATIONS = 3


# Trips


def top_n_vehicles(spark: SparkSession, folder: str) -> DataFrame:
    return op.top_n_vehicles(rides(spark, folder), TOP_N)


def station_trip_balance(spark: SparkSession, folder: str) -> DataFrame:
    return op.station_trip_balance(trips(spark, folder))


def station_trip_balance_join(spark: SparkSession, folder: str) -> DataFrame:
    return op.station_trip_balance_join(trips(spark, folder))


def station_trip_balance_parties(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers and customers as stations: many are seen on one side only."""
    return op.station_trip_balance(
        flow_edges(spark, folder).select(
            F.col("source").cast("string").alias("start_station_name"),
            F.col("target").cast("string").alias("stop_station_name"),
        )
    )


def vehicle_relocations(spark: SparkSession, folder: str) -> DataFrame:
    return op.vehicle_relocations(
        trips(spark, folder, VEHICLE), VEHICLE, TRIP_TIE_BREAK, count_from=rides(spark, folder)
    )


def vehicle_relocations_all(spark: SparkSession, folder: str) -> DataFrame:
    return op.vehicle_relocations(
        trips(spark, folder), None, TRIP_TIE_BREAK, count_from=rides(spark, folder)
    )


def relocation_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Every trip, with the columns that say whether its vehicle was moved to it."""
    return op.relocation_flags(
        trips(spark, folder), TRIP_TIE_BREAK, count_from=rides(spark, folder)
    )


def cheapest_pair(spark: SparkSession, folder: str) -> DataFrame:
    """The pair of stations with the fewest trips."""
    return (
        trips(spark, folder)
        .groupBy("start_station_name", "stop_station_name")
        .agg(F.count("*").alias("num_trips"))
        .orderBy("num_trips", "start_station_name", "stop_station_name")
        .limit(1)
    )


# Graph


def out_degree(spark: SparkSession, folder: str) -> DataFrame:
    return op.out_degree(flow_edges(spark, folder))


def distinct_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return op.distinct_nodes(flow_edges(spark, folder))


def node_count(spark: SparkSession, folder: str) -> DataFrame:
    return op.node_count(flow_edges(spark, folder))


def positive_source_edges(spark: SparkSession, folder: str) -> DataFrame:
    edges = flow_edges(spark, folder)
    return edges.filter(F.col("source") > 0).agg(F.count("*").alias("num_edges"))


def adjacency(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbour lists as text, since the check compares plain values."""
    return op.build_adjacency(flow_edges(spark, folder)).withColumn(
        "neighbours", F.concat_ws(",", F.col("neighbours").cast("array<string>"))
    )


def pagerank_in(spark: SparkSession, folder: str) -> DataFrame:
    ranks = op.pagerank(flow_edges(spark, folder), RESET_PROBABILITY, ITERATIONS, "in")
    return op.rank_listing(ranks)


def pagerank_out(spark: SparkSession, folder: str) -> DataFrame:
    ranks = op.pagerank(trade_edges(spark, folder), RESET_PROBABILITY, ITERATIONS, "out")
    return op.rank_listing(ranks)


def rank_listing(spark: SparkSession, folder: str) -> DataFrame:
    return rank_listing_lines(pagerank_in(spark, folder))


def shortest_paths(spark: SparkSession, folder: str) -> DataFrame:
    return op.shortest_paths(flow_edges(spark, folder), START_NODE)


def shortest_paths_with_sinks(spark: SparkSession, folder: str) -> DataFrame:
    return op.shortest_paths(flow_edges(spark, folder), START_NODE, include_sinks=True)


def path_listing(spark: SparkSession, folder: str) -> DataFrame:
    return row_listing(shortest_paths(spark, folder))


# Single steps of the path search


def _first_step(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Edges, paths, frontier and best edge; the edges are made once, the best edge is one row."""
    edges = cut_lineage(flow_edges(spark, folder))
    paths = op.initial_paths(edges, START_NODE)
    frontier = op.initial_frontier(edges, START_NODE)
    return edges, paths, frontier, cut_lineage(op.best_frontier_edge(paths, frontier))


def best_frontier_edge(spark: SparkSession, folder: str) -> DataFrame:
    return _first_step(spark, folder)[3]


def settled_paths(spark: SparkSession, folder: str) -> DataFrame:
    _, paths, _, best = _first_step(spark, folder)
    return op.settle(paths, best)


def unused_edges(spark: SparkSession, folder: str) -> DataFrame:
    edges, _, _, best = _first_step(spark, folder)
    return op.drop_used_edge(edges, best)


def unvisited_targets(spark: SparkSession, folder: str) -> DataFrame:
    edges, paths, _, best = _first_step(spark, folder)
    return op.edges_to_unvisited(edges, op.settle(paths, best))


def union_frontier(spark: SparkSession, folder: str) -> DataFrame:
    edges, _, frontier, best = _first_step(spark, folder)
    return frontier.unionByName(op.edges_leaving(edges, best))


def next_frontier(spark: SparkSession, folder: str) -> DataFrame:
    edges = cut_lineage(flow_edges(spark, folder))
    paths = op.initial_paths(edges, START_NODE)
    return op.advance(edges, paths, op.initial_frontier(edges, START_NODE))[1]


# Comparison


def _pair_weights(spark: SparkSession, folder: str) -> DataFrame:
    return flow_edges(spark, folder).groupBy("source", "target").agg(F.sum("weight").alias("weight"))


def _changed(pairs: DataFrame) -> DataFrame:
    """Edges of customers (even ids) gone, those of the start node one heavier."""
    heavier = F.when(F.col("source") == START_NODE, F.col("weight") + 1).otherwise(F.col("weight"))
    return pairs.filter(F.col("source") % 2 == 1).withColumn("weight", heavier)


def result_diff(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _pair_weights(spark, folder)
    return op.diff_by_key(pairs, _changed(pairs), ["source", "target"])


def result_diff_positional(spark: SparkSession, folder: str) -> DataFrame:
    pairs = _pair_weights(spark, folder)
    return op.diff_by_position(pairs, _changed(pairs), ["source", "target"], pairs.columns)


def result_diff_unordered(spark: SparkSession, folder: str) -> DataFrame:
    edges = flow_edges(spark, folder)
    return op.diff_as_multiset(edges, trade_edges(spark, folder))


# Files: the tables are written in the text formats and read back


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which every executor can reach; it goes with the session."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/files-{uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return f"{folder}/{name}"


def trip_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All columns of trip files: nations give the stations' ids and places, the line the rider."""
    path = _scratch(spark, "trips")
    clock = "yyyy/MM/dd HH:mm:ss"
    trips(spark, folder, full=True).select(
        F.date_format("start_time", clock).alias("start_time"),
        F.date_format("stop_time", clock).alias("stop_time"),
        "trip_duration",
        F.col("s_nationkey").alias("start_station_id"),
        "start_station_name",
        (F.col("s_nationkey") * 0.5).alias("start_station_latitude"),
        (F.col("s_nationkey") * -1.25).alias("start_station_longitude"),
        F.col("c_nationkey").alias("stop_station_id"),
        "stop_station_name",
        (F.col("c_nationkey") * 0.5).alias("stop_station_latitude"),
        (F.col("c_nationkey") * -1.25).alias("stop_station_longitude"),
        "bike_id",
        F.col("l_returnflag").alias("user_type"),
        (F.col("k2") + 1950).alias("birth_year"),
        (F.col("k2") % 3).alias("gender"),
        F.col("k1").alias("trip_id"),
    ).write.csv(path, sep=",", header=False)
    return read_trips(spark, path)


def _edge_files(spark: SparkSession, folder: str) -> str:
    path = _scratch(spark, "edges")
    flow_edges(spark, folder).write.csv(path, sep=" ", header=False)
    return path


def edge_file_scan(spark: SparkSession, folder: str) -> DataFrame:
    return read_edges(spark, _edge_files(spark, folder))


def edge_file_scan_strict(spark: SparkSession, folder: str) -> DataFrame:
    return read_edges_strict(spark, _edge_files(spark, folder))


def rank_listing_file(spark: SparkSession, folder: str) -> DataFrame:
    path = _scratch(spark, "ranks")
    write_listing(rank_listing(spark, folder), path)
    return read_listing(spark, path).select("line")


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        top_n_vehicles,
        station_trip_balance,
        station_trip_balance_join,
        station_trip_balance_parties,
        vehicle_relocations,
        vehicle_relocations_all,
        relocation_flags,
        cheapest_pair,
        out_degree,
        distinct_nodes,
        node_count,
        positive_source_edges,
        adjacency,
        pagerank_in,
        pagerank_out,
        rank_listing,
        shortest_paths,
        shortest_paths_with_sinks,
        path_listing,
        best_frontier_edge,
        settled_paths,
        unused_edges,
        unvisited_targets,
        union_frontier,
        next_frontier,
        result_diff,
        result_diff_positional,
        result_diff_unordered,
        trip_file_scan,
        edge_file_scan,
        edge_file_scan_strict,
        rank_listing_file,
    )
}
