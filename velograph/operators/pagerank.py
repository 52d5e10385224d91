"""PageRank with a fixed number of iterations, not normalised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.functions import round_exact
from velograph.layout import ROWS_PER_TASK, heavy_keys, sliced_table
from velograph.layout.rounds import Rounds
from velograph.operators.adjacency import complete_edges


def pagerank(
    edges: DataFrame,
    reset_probability: float = 0.15,
    max_iterations: int = 3,
    direction: str = "in",
    rows_per_task: int = ROWS_PER_TASK,
    checkpoint_interval: int = 5,
    drop_incomplete: bool = False,
    state_folder: str | None = None,
) -> DataFrame:
    """Rank of every node: ``id, pagerank``.

    Ranks start at 1. In each iteration a node gets
    ``reset_probability + (1 - reset_probability) * sum(rank / out-degree)`` over its neighbours:
    with ``direction="in"`` those that point at it, the usual definition, with ``"out"`` those it
    points at. Both agree when every edge has its reverse. Parallel edges count each, weights are
    ignored. ``"out"`` is undefined for a neighbour without outgoing edges and is refused then. An edge without source or
    target is refused, or left out with ``drop_incomplete``.

    Edges and nodes are written tables, hashed on the node, that every iteration reads where they are,
    also after the loss of an executor. An iteration shuffles combined partial sums to the nodes and
    nothing else; ranks are hashed like the edges they go to. Edges of a hub are sliced over tasks and
    its rank is sent to each slice. Every ``checkpoint_interval`` iterations the ranks are written too.

    With ``state_folder``, which all executors share, the tables stay there, and a call that finds them
    goes on after the last ranks written. It must be for the same edges and settings but for
    ``max_iterations``.
    """
    if direction not in ("in", "out"):
        raise ValueError(f"direction must be 'in' or 'out', not {direction!r}")
    giver, taker = ("source", "target") if direction == "in" else ("target", "source")
    spark = edges.sparkSession
    rounds = Rounds(spark, state_folder) if state_folder else None
    done = rounds.last() if rounds else None
    if done is not None and done["round"] > max_iterations:
        raise ValueError(f"the folder holds iteration {done['round']} already, past {max_iterations}")
    if done is None:
        links = (
            complete_edges(edges, "source", "target", drop_incomplete=drop_incomplete)
            .groupBy("source", "target")
            .agg(F.count("*").alias("copies"))
            .persist()
        )
        try:
            sliced = sliced_table(links, heavy_keys(links, giver, rows_per_task), [taker], "edges", state_folder)
        finally:
            links.unpersist()
    else:
        sliced = sliced_table(None, None, [taker], "edges", state_folder, done, spark)
    tables, placed = sliced.tables, sliced.rows
    try:
        if done is None:
            degrees = (
                placed.select(F.col("source").alias("id"), F.col("copies").alias("degree"))
                .union(placed.select("target", F.lit(0).cast("bigint")))
                .groupBy("id")
                .agg(F.sum("degree").alias("degree"))
            )
            tables.delete("nodes")
            tables.write("nodes", degrees, ["id"])
        else:
            tables.find("nodes", done["nodes"], ["id"])
        nodes = tables.read("nodes")
        if direction == "out" and not nodes.filter(F.col("degree") == 0).isEmpty():
            raise ValueError("direction 'out': a neighbour has no outgoing edges to share its rank over")
        ranks, first = nodes.withColumn("pagerank", F.lit(1.0)), 1
        rank_columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranks.schema)
        if done is not None:
            first = done["round"] + 1
            tables.find(f"ranks{done['round']}", rank_columns, ["id"])
            ranks = tables.read(f"ranks{done['round']}")
        for iteration in range(first, max_iterations + 1):
            shares = sliced.spread(
                ranks.filter(F.col("degree") > 0).select(
                    F.col("id").alias(giver), (F.col("pagerank") / F.col("degree")).alias("share")
                )
            )
            received = (
                placed.join(shares, sliced.join_keys)
                .groupBy(F.col(taker).alias("id"))
                .agg(F.sum(F.col("share") * F.col("copies")).alias("received"))
            )
            ranks = nodes.join(received, "id", "left").select(
                "id",
                "degree",
                (
                    F.lit(reset_probability)
                    + (1 - reset_probability) * F.coalesce("received", F.lit(0.0))
                ).alias("pagerank"),
            )
            if iteration % checkpoint_interval == 0 and (rounds or iteration < max_iterations):
                tables.delete(f"ranks{iteration}")
                tables.write(f"ranks{iteration}", ranks, ["id"])
                ranks = tables.read(f"ranks{iteration}")
                if rounds:
                    node_columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema)
                    rounds.add({"round": iteration, "nodes": node_columns} | sliced.description())
        return tables.hand_back(ranks.select("id", "pagerank"))
    finally:
        tables.close()


def rank_listing(ranks: DataFrame) -> DataFrame:
    """Ranks rounded to two places, highest first, equal ranks by descending id."""
    return ranks.select("id", round_exact(F.col("pagerank"), 2).alias("pagerank")).orderBy(
        F.desc("pagerank"), F.desc("id")
    )
