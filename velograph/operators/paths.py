"""Single-source shortest paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from velograph.layout import ROWS_PER_TASK, cut_lineage, small_tasks, written_for_now
from velograph.layout.buckets import BucketedTables
from velograph.layout.rounds import Rounds
from velograph.layout.skew import SlicedRows, heavy_keys, sliced_table
from velograph.operators.adjacency import complete_edges

# Rounds after which the known nodes are written anew as one file per bucket.
COMPACT_ROUNDS = 16


def shortest_paths(
    edges: DataFrame,
    source_node: int,
    include_sinks: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    drop_incomplete: bool = False,
    cost_step: int | None = None,
    state_folder: str | None = None,
) -> DataFrame:
    """Least cost and path from ``source_node`` to every node: ``id, cost, path``, ordered by id.

    Nodes are those with outgoing edges; ``include_sinks`` adds the others. A path reads
    ``1-2-4``. An unreached node has cost -1 and an empty path. Of equally cheap paths the one with
    the fewest hops is taken, and of these the one whose last node but one has the least id, that
    node's own path being chosen alike. Self-loops never help and are ignored; of parallel edges the
    cheapest counts. Weights must not be negative. An edge without source, target or weight is
    refused, or left out with ``drop_incomplete``.

    The texts of all paths can be far larger than the graph; ``shortest_path_tree`` with ``paths_to``
    gives those that are asked for. See there for how the search runs.
    """
    tree = shortest_path_tree(
        edges, source_node, include_sinks, rows_per_task, drop_incomplete, cost_step, state_folder
    )
    texts = _path_texts(tree.filter("cost >= 0"))
    listed = tree.select("id").join(texts, "id", "left").select(
        "id", F.coalesce("cost", F.lit(-1)).alias("cost"), F.coalesce("path", F.lit("")).alias("path")
    )
    return cut_lineage(listed).orderBy("id")


def shortest_path_tree(
    edges: DataFrame,
    source_node: int,
    include_sinks: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
    drop_incomplete: bool = False,
    cost_step: int | None = None,
    state_folder: str | None = None,
) -> DataFrame:
    """Cost, hops and predecessor of every node: ``id, cost, hops, previous``.

    The paths are those of ``shortest_paths``; an unreached node has cost -1 and neither hops nor
    predecessor, and the source has no predecessor.

    Edges and known nodes are written tables, hashed on their node. Each round relaxes the edges of the
    nodes that the round before improved, all at once, and shuffles only the combined candidates, to
    where the known nodes are; those that are better are added to the known nodes' table. Edges and
    known nodes stay where they are, and what a round writes follows the nodes that it improved. The
    rounds follow the number of hops of the best paths. With ``cost_step`` a round takes only improved
    nodes below a cost limit, which rises by that step whenever none is left: more rounds, but a node is
    seldom relaxed before its cost is final. Edges of a hub are sliced over tasks.

    With ``state_folder``, which all executors share, the tables stay there with a list of the finished
    rounds, and a call that finds them goes on after the last one. It must be for the same edges and
    source.
    """
    spark = edges.sparkSession
    rounds = Rounds(spark, state_folder) if state_folder else None
    done = rounds.last() if rounds else None
    if done is None:
        pairs = (
            complete_edges(edges, "source", "target", "weight", drop_incomplete=drop_incomplete)
            .groupBy("source", "target")
            .agg(F.min("weight").cast("bigint").alias("weight"))
        )
        # Made once, as columns in files: a cache of all pairs would take the memory that sorts need.
        facts = Observation()
        counted = pairs.observe(facts, F.count("*").alias("n_pairs"), F.count_if(F.col("weight") < 0).alias("n_negative"))
        with small_tasks(spark), written_for_now(counted) as pairs:
            _check_weights(facts.get)
            heavy = heavy_keys(pairs, "source", rows_per_task)
            sliced = sliced_table(pairs, heavy, ["target"], "edges", state_folder)
        state = _first_state(sliced.tables, pairs.schema["source"].dataType.simpleString(), source_node)
    else:
        sliced = sliced_table(None, None, ["target"], "edges", state_folder, done, spark)
        state = done
    try:
        state = _search(sliced, state, cost_step, rounds)
        placed = sliced.rows
        nodes = placed.select(F.col("source").alias("id")).distinct()
        if include_sinks:
            nodes = nodes.union(placed.select("target")).distinct()
        known = _known(sliced.tables.read(state["table"]), state["round"])
        found = nodes.join(known, "id", "left").select(
            "id", F.coalesce("best.cost", F.lit(-1)).alias("cost"), "best.hops", "best.previous"
        )
        return sliced.tables.hand_back(found)
    finally:
        sliced.tables.close()


def _check_weights(facts: dict) -> None:
    if not facts["n_pairs"]:
        raise ValueError("no edges to search")
    if facts["n_negative"]:
        raise ValueError(f"{facts['n_negative']} pairs of nodes have a negative weight")


def _first_state(tables: BucketedTables, id_type: str, source_node: int) -> dict:
    """The known nodes before the first round: the source alone."""
    start = tables.spark.range(1).selectExpr(
        f"CAST({source_node} AS {id_type}) AS id", "0L AS cost", "0 AS hops", f"CAST(NULL AS {id_type}) AS previous",
        "true AS improved", "0 AS round",
    )
    tables.delete("known0")
    tables.write("known0", tables.place(start, ["id"]), ["id"], ["round"])
    return {"table": "known0", "round": 0, "id_type": id_type, "limit": None}


def _known(table: DataFrame, last_round: int) -> DataFrame:
    """The best of each known node; rounds after ``last_round``, if any, were not finished."""
    rows = table.filter(F.col("round") <= last_round)
    return rows.groupBy("id").agg(F.min(F.struct("cost", "hops", "previous")).alias("best"))


def _search(sliced: SlicedRows, state: dict, cost_step: int | None, rounds: Rounds | None) -> dict:
    """Rounds until nothing improves; returns where the known nodes are."""
    tables = sliced.tables
    if state["round"]:
        # Taken up again: what a round that was not finished left behind goes.
        tables.delete(f"{state['table']}/round={state['round'] + 1}")
        columns = "id {0}, cost BIGINT, hops INT, previous {0}, improved BOOLEAN, round INT".format(state["id_type"])
        tables.find(state["table"], columns, ["id"], ["round"])
    limit, fresh = state["limit"], state["round"] == 0
    if cost_step and limit is None:
        limit = cost_step
    while True:
        known = tables.read(state["table"])
        frontier = known.filter((F.col("round") == state["round"]) & F.col("improved"))
        if limit is not None:
            frontier = frontier.filter(F.col("cost") < limit)
        n_improved = 1 if fresh else state["pending"]
        if not n_improved and limit is not None:
            # Nodes at or beyond the limit have waited; the cheapest of them set the next one.
            waiting = _known(known, state["round"]).filter(F.col("best.cost") >= limit)
            least = waiting.agg(F.min("best.cost")).first()[0]
            if least is not None:
                lower, limit = limit, least + cost_step
                frontier = waiting.filter(F.col("best.cost").between(lower, limit - 1)).select("id", "best.*")
                n_improved = 1
        if not n_improved:
            return state
        state = _relax(sliced, state, known, frontier, limit)
        fresh = False
        outdated = state["table"]
        if state["round"] % COMPACT_ROUNDS == 0:
            state = _compact(tables, state)
        if rounds:
            rounds.add(state | sliced.description())
        if state["table"] != outdated:
            tables.drop(outdated)


def _improvements(sliced: SlicedRows, known: DataFrame, frontier: DataFrame, last_round: int) -> DataFrame:
    """Nodes that one hop from the frontier makes better: ``id, cost, hops, previous, improved``.

    The frontier is hashed like the edges, unless a hub's part of it is spread over slices, and the
    combined candidates are shuffled to where the known nodes are.
    """
    reached = sliced.spread(frontier.select(F.col("id").alias("source"), "cost", "hops")).hint("shuffle_hash")
    extended = sliced.rows.filter("source <> target").join(reached, sliced.join_keys).select(
        F.col("target").alias("id"),
        F.struct(
            (F.col("cost") + F.col("weight")).alias("cost"),
            (F.col("hops") + 1).alias("hops"),
            F.col("source").alias("previous"),
        ).alias("best"),
    )
    candidates = extended.groupBy("id").agg(F.min("best").alias("best"))
    before = _known(known, last_round).select(F.col("id").alias("_id"), F.col("best").alias("before"))
    better = candidates.join(before, F.col("id") == F.col("_id"), "left").filter(
        F.col("before").isNull() | (F.col("best") < F.col("before"))
    )
    # Another predecessor at the same cost and hops changes nothing for the nodes beyond.
    same = F.col("best.cost").eqNullSafe(F.col("before.cost")) & F.col("best.hops").eqNullSafe(F.col("before.hops"))
    return better.select("id", "best.*", (~same).alias("improved"))


def _relax(sliced: SlicedRows, state: dict, known: DataFrame, frontier: DataFrame, limit: int | None) -> dict:
    """One round: add what the frontier makes better to the known nodes."""
    following = state["round"] + 1
    rows = _improvements(sliced, known, frontier, state["round"]).withColumn("round", F.lit(following))
    pending = F.col("improved") if limit is None else F.col("improved") & (F.col("cost") < limit)
    observed = Observation()
    added = rows.observe(observed, F.count_if(pending).alias("pending"))
    sliced.tables.write(state["table"], added, ["id"], ["round"])
    return state | {"round": following, "limit": limit, "pending": observed.get["pending"]}


def _compact(tables: BucketedTables, state: dict) -> dict:
    """The known nodes written anew, one file per bucket and one row per node; the last round's are marked."""
    last = F.max(F.struct("round", "improved")).alias("last")
    rows = tables.read(state["table"]).filter(F.col("round") <= state["round"])
    now = rows.groupBy("id").agg(F.min(F.struct("cost", "hops", "previous")).alias("best"), last).select(
        "id", "best.*", "last.improved", F.when(F.col("last.round") == state["round"], state["round"]).otherwise(-1).alias("round")
    )
    table = f"known{state['round']}"
    tables.delete(table)
    tables.write(table, now, ["id"], ["round"])
    return state | {"table": table}


def _path_texts(tree: DataFrame) -> DataFrame:
    """Cost and path text of all reached nodes, by pointer doubling along the predecessors.

    ``path`` first names the node alone and ``up`` its predecessor; a round puts the text of ``up``
    in front and goes on from where that one stands. Both sides of the join are written, so adaptive
    execution splits the many nodes that share an ancestor.
    """
    paths = cut_lineage(tree.select("id", "cost", F.col("previous").alias("up"), F.col("id").cast("string").alias("path")))
    longest = tree.agg(F.max("hops")).first()[0] or 0
    for _ in range(longest.bit_length()):
        above = paths.select(F.col("id").alias("up"), F.col("path").alias("front"), F.col("up").alias("further"))
        longer = paths.filter("up IS NOT NULL").join(above, "up").select(
            "id", "cost", F.col("further").alias("up"), F.concat_ws("-", "front", "path").alias("path")
        )
        paths = cut_lineage(paths.filter("up IS NULL").unionByName(longer))
    return paths.select("id", "cost", "path")


def paths_to(tree: DataFrame, nodes: DataFrame) -> DataFrame:
    """Paths to the asked ``nodes`` (id) only, from a ``shortest_path_tree``: ``id, cost, path``.

    A node that the tree does not have or did not reach has cost -1 and an empty path; a node asked for
    twice is listed once, a null one not at all.

    Pointer jumping: tables of ids say which node is 1, 2, 4, ... hops before each. From the longest jump
    down, each jump from the places known so far on an asked node's path gives as many new ones, so the
    work beyond the tables follows the hops of the asked paths, and no other path is ever spelled out.
    """
    tree = cut_lineage(tree.filter("cost >= 0").select("id", "cost", "hops", "previous"))
    asked = nodes.select("id").filter("id IS NOT NULL").distinct()
    found = cut_lineage(asked.join(tree, "id").select("id", "cost", "hops"))
    longest = found.agg(F.max("hops")).first()[0] or 0
    jump = tree.filter("previous IS NOT NULL").select(F.col("id").alias("at"), F.col("previous").alias("to"))
    jumps = []
    for level in range(longest.bit_length()):
        if level:
            onward = jump.select(F.col("at").alias("to"), F.col("to").alias("further"))
            jump = cut_lineage(jump.join(onward, "to").select("at", F.col("further").alias("to")))
        jumps.append(jump)
    places = found.select("id", F.col("id").alias("at"), F.lit(0).alias("back"))
    for level in range(len(jumps) - 1, -1, -1):
        step = places.join(jumps[level], "at").select("id", F.col("to").alias("at"), (F.col("back") + 2**level).alias("back"))
        places = cut_lineage(places.unionByName(step))
    order = F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("place"), F.col("at").cast("string").alias("name"))))
    texts = places.groupBy("id").agg(F.array_join(F.transform(order, lambda p: p["name"]), "-").alias("path"))
    reached = found.join(texts, "id").select("id", "cost", "path")
    return asked.join(reached, "id", "left").select(
        "id", F.coalesce("cost", F.lit(-1)).alias("cost"), F.coalesce("path", F.lit("")).alias("path")
    )
