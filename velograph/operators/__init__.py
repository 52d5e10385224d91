"""The end-user operators. All take and return DataFrames."""

from velograph.operators.adjacency import build_adjacency, distinct_nodes, node_count, out_degree
from velograph.operators.compare import diff_as_multiset, diff_by_key, diff_by_position, diff_listings
from velograph.operators.frontier import (
    advance,
    best_frontier_edge,
    drop_used_edge,
    edges_leaving,
    edges_to_unvisited,
    initial_frontier,
    initial_paths,
    settle,
)
from velograph.operators.pagerank import pagerank, rank_listing
from velograph.operators.paths import paths_to, shortest_path_tree, shortest_paths
from velograph.operators.stations import station_trip_balance, station_trip_balance_join
from velograph.operators.vehicles import relocation_flags, top_n_vehicles, vehicle_relocations

__all__ = [
    "advance",
    "best_frontier_edge",
    "build_adjacency",
    "diff_as_multiset",
    "diff_by_key",
    "diff_by_position",
    "diff_listings",
    "distinct_nodes",
    "drop_used_edge",
    "edges_leaving",
    "edges_to_unvisited",
    "initial_frontier",
    "initial_paths",
    "node_count",
    "out_degree",
    "pagerank",
    "paths_to",
    "rank_listing",
    "relocation_flags",
    "settle",
    "shortest_path_tree",
    "shortest_paths",
    "station_trip_balance",
    "station_trip_balance_join",
    "top_n_vehicles",
    "vehicle_relocations",
]
