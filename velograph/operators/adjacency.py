"""Nodes, degrees and neighbour lists of an edge table ``(source, target, ...)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velograph.layout import HeavyKeys, heavy_keys, written

# Neighbours in one list: 8 MB of BIGINT ids.
NEIGHBOURS_PER_BLOCK = 1_000_000


def complete_edges(edges: DataFrame, *columns: str, drop_incomplete: bool = False) -> DataFrame:
    """``columns`` of the edges, which all need a value, for use by every graph operator.

    An edge without one fails the query, or is left out with ``drop_incomplete``.
    """
    if drop_incomplete:
        return edges.select(*columns).na.drop()
    shown = F.concat_ws(", ", *(F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns))
    wrong = F.raise_error(F.concat(F.lit(f"edge without {' or '.join(columns)}: "), shown))
    return edges.select(
        *(F.coalesce(c, wrong.cast(edges.schema[c].dataType)).alias(c) for c in columns)
    )


def distinct_nodes(edges: DataFrame, drop_incomplete: bool = False) -> DataFrame:
    """All node ids, sources and targets, once each, in column ``id``."""
    edges = complete_edges(edges, "source", "target", drop_incomplete=drop_incomplete)
    return edges.select(F.explode(F.array("source", "target")).alias("id")).distinct()


def node_count(edges: DataFrame, drop_incomplete: bool = False) -> DataFrame:
    """Number of distinct nodes, as one row ``num_nodes``."""
    return distinct_nodes(edges, drop_incomplete).agg(F.count("*").alias("num_nodes"))


def out_degree(edges: DataFrame, drop_incomplete: bool = False) -> DataFrame:
    """Outgoing edges per source, parallel edges included: ``id``, ``num_neighbours``."""
    edges = complete_edges(edges, "source", "target", drop_incomplete=drop_incomplete)
    return edges.groupBy(F.col("source").alias("id")).agg(F.count("target").alias("num_neighbours"))


def build_adjacency(
    edges: DataFrame,
    neighbours_per_block: int = NEIGHBOURS_PER_BLOCK,
    drop_incomplete: bool = False,
) -> DataFrame:
    """Out-degree and out-neighbours per node: ``id, num_neighbours, block, neighbours``.

    Parallel edges repeat the neighbour, weights are ignored, and a node without outgoing edges
    has ``num_neighbours`` 0 and an empty list.

    A node's sorted neighbours come in blocks of ``neighbours_per_block``, numbered from 0 without
    gaps, the last one holding what is left: block k has the neighbours k * size to (k + 1) * size
    - 1. ``num_neighbours`` is the node's total in each of them.

    Nodes whose neighbours fit into one block, found by a counting pass, are put together by one
    shuffle and never written. Of the others, the hubs, parallel edges are combined and the pairs
    range-sorted and written once, as columns; a pair's place among its node's neighbours follows
    from sums per node and partition, so no task holds more of a hub than a partition or a block.
    """
    edges = complete_edges(edges, "source", "target", drop_incomplete=drop_incomplete)
    hubs = heavy_keys(edges, "source", neighbours_per_block)
    # Each edge also names its target as a node without neighbour, so that sinks are kept.
    none = F.lit(None).cast(edges.schema["target"].dataType).alias("target")
    named = edges.select(F.inline(F.array(F.struct("source", "target"), F.struct(F.col("target").alias("source"), none))))
    if hubs:
        named = named.join(hubs.for_join("source"), "source", "left_anti")
    listed = named.groupBy(F.col("source").alias("id")).agg(
        F.count("target").alias("num_neighbours"), F.sort_array(F.collect_list("target")).alias("neighbours")
    )
    listed = listed.select("id", "num_neighbours", F.lit(0).alias("block"), "neighbours")
    return listed.unionByName(_hub_blocks(edges, hubs, neighbours_per_block)) if hubs else listed


def _hub_blocks(edges: DataFrame, hubs: HeavyKeys, neighbours_per_block: int) -> DataFrame:
    """The blocks of the hubs' neighbours."""
    pairs = edges.join(hubs.for_join("source"), "source", "left_semi").groupBy("source", "target")
    pairs = pairs.agg(F.count("*").alias("copies"))
    n_parts = max(1, -(-hubs.heavy_rows // neighbours_per_block))
    placed = written(
        pairs.repartitionByRange(n_parts, "source", "target")
        .sortWithinPartitions("source", "target")
        .withColumn("_part", F.spark_partition_id())
    )
    # One row per hub and partition of it: what its earlier partitions hold.
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("source", "_part").agg(F.sum("copies").alias("_sum"))
    offsets = offsets.select(
        "source",
        "_part",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(Window.partitionBy("source")).alias("num_neighbours"),
    )
    before = Window.partitionBy("source", "_part").orderBy("target").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("_before", F.coalesce(F.sum("copies").over(before), F.lit(0)))
    size, start = F.lit(neighbours_per_block), F.col("_before") + F.col("_offset")
    first_block, last_block = F.floor(start / size), F.floor((start + F.col("copies") - 1) / size)
    in_block = F.least(start + F.col("copies"), (F.col("block") + 1) * size) - F.greatest(start, F.col("block") * size)
    return (
        numbered.join(offsets, ["source", "_part"])
        .withColumn("block", F.explode(F.sequence(first_block, last_block)))
        .withColumn("listed", F.array_repeat("target", in_block.cast("int")))
        .groupBy(F.col("source").alias("id"), F.col("block").cast("int").alias("block"))
        .agg(
            F.first("num_neighbours").alias("num_neighbours"),
            F.sort_array(F.flatten(F.collect_list("listed"))).alias("neighbours"),
        )
        .select("id", "num_neighbours", "block", "neighbours")
    )
