"""Steps of a search that settles one node at a time.

``paths`` has ``id, cost, path`` with cost -1 for nodes not settled yet; ``frontier`` has the
edges ``source, target, weight`` that leave settled nodes. ``shortest_paths`` answers the whole
question in far fewer jobs; these are the single steps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.layout import cut_lineage

UNVISITED = -1


def initial_paths(edges: DataFrame, source_node: int) -> DataFrame:
    """Every node with outgoing edges, only ``source_node`` settled, at cost 0."""
    start = F.col("source") == source_node
    return (
        edges.select("source")
        .distinct()
        .select(
            F.col("source").alias("id"),
            F.when(start, 0).otherwise(UNVISITED).cast("bigint").alias("cost"),
            F.when(start, str(source_node)).otherwise("").alias("path"),
        )
    )


def initial_frontier(edges: DataFrame, source_node: int) -> DataFrame:
    """Edges that leave ``source_node``; a loop leads nowhere and is none of them."""
    leaving = (F.col("source") == source_node) & (F.col("target") != source_node)
    return edges.filter(leaving).select("source", "target", "weight")


def best_frontier_edge(paths: DataFrame, frontier: DataFrame) -> DataFrame:
    """The frontier edge whose target costs least; ties go to the least path, then target.

    One row ``candidate_source, candidate_target, candidate_cost, candidate_path``, the path being
    that of the source; no row when the frontier is empty.
    """
    settled = paths.select(F.col("id").alias("source"), "cost", "path")
    return (
        frontier.join(settled, "source")
        .select(
            F.col("source").alias("candidate_source"),
            F.col("target").alias("candidate_target"),
            (F.col("cost") + F.col("weight")).alias("candidate_cost"),
            F.col("path").alias("candidate_path"),
        )
        .orderBy("candidate_cost", "candidate_path", "candidate_target", "candidate_source")
        .limit(1)
    )


# ``best`` below is a result of best_frontier_edge, at most one row, hence broadcast.


def settle(paths: DataFrame, best: DataFrame) -> DataFrame:
    """Give the target of ``best`` its cost and path."""
    update = best.select(F.col("candidate_target").alias("id"), "candidate_cost", "candidate_path")
    hit = F.col("candidate_cost").isNotNull()
    reached_by = F.concat_ws("-", "candidate_path", F.col("id").cast("string"))
    return paths.join(F.broadcast(update), "id", "left").select(
        "id",
        F.when(hit, F.col("candidate_cost")).otherwise(F.col("cost")).alias("cost"),
        F.when(hit, reached_by).otherwise(F.col("path")).alias("path"),
    )


def drop_used_edge(frontier: DataFrame, best: DataFrame) -> DataFrame:
    """The frontier without the edge, or parallel edges, of ``best``."""
    used = best.select(
        F.col("candidate_source").alias("source"), F.col("candidate_target").alias("target")
    )
    return frontier.join(F.broadcast(used), ["source", "target"], "left_anti")


def edges_to_unvisited(frontier: DataFrame, paths: DataFrame) -> DataFrame:
    """The frontier edges whose target is not settled."""
    unvisited = paths.filter(F.col("cost") == UNVISITED).select(F.col("id").alias("target"))
    return frontier.join(unvisited, "target", "left_semi").select("source", "target", "weight")


def edges_leaving(edges: DataFrame, best: DataFrame) -> DataFrame:
    """The edges that leave the target of ``best``, loops left out."""
    reached = best.select(F.col("candidate_target").alias("source"))
    return edges.filter("source <> target").join(F.broadcast(reached), "source").select("source", "target", "weight")


def advance(
    edges: DataFrame, paths: DataFrame, frontier: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """One whole step: settle the best edge's target and move the frontier past it.

    The best edge and both results are written, so that the plan of a step does not hold all the
    steps before it.
    """
    best = cut_lineage(best_frontier_edge(paths, frontier))
    settled = cut_lineage(settle(paths, best))
    open_edges = drop_used_edge(frontier, best).unionByName(edges_leaving(edges, best))
    return settled, cut_lineage(edges_to_unvisited(open_edges, settled))
