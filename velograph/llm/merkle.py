"""A Merkle manifest of a table: a tree of digests per group of rows, and one tree over their roots.

Every consecutive run of nodes becomes the digest of its digests, level by level, until one is left. A
parent retains a copy of its hash state before each child slot. To fold a changed child upwards, the state
that matches its slot goes on with the replacement and the siblings to its right only; what is to its left
is in the state already.

A task holds a subtree: the leaves of some consecutive positions and all levels over them. Roots of
subtrees are the nodes of the next tier, which is cut into subtrees again, so a tree over n rows takes
log(n) / ``SUBTREE_LEVELS`` tiers and no task or driver ever sees more than one subtree. On the way down
each subtree gets the path from its root to the top: per level, the siblings before and after. Hash states
cannot be sent from task to task, so a task makes the states of these few parents again, once for all
leaves of its subtree, and keeps the copies of its own parents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from velograph.llm.common import Workspace

# Children of a node, and levels that one task holds: at most ARITY ** SUBTREE_LEVELS leaves.
ARITY = 2
SUBTREE_LEVELS = 10
# Rows that are worth a task of their own when positions are given.
ROWS_PER_TASK = 1_000_000

_INDEX_BITS = 33


def leaf_digest(columns: Sequence[Column]) -> Column:
    """The digest of a row: each value as its number of UTF-8 bytes, a colon and itself; null as ``-``."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


class Subtree:
    """The levels over some consecutive nodes (hex digests as bytes), with the states of all parents."""

    def __init__(self, nodes: list[bytes], levels: int, arity: int = ARITY) -> None:
        self.arity = arity
        self.nodes = [nodes]
        # By level: for each node the state of its parent before the node's slot.
        self.states: list[list] = []
        for _ in range(levels):
            below, before, parents = self.nodes[-1], [], []
            for first in range(0, len(below), arity):
                state = sha256()
                for child in below[first : first + arity]:
                    before.append(state.copy())
                    state.update(child)
                parents.append(state.hexdigest().encode())
            self.states.append(before)
            self.nodes.append(parents)

    @property
    def root(self) -> bytes:
        return self.nodes[-1][0]

    def siblings(self, at: int) -> list[tuple[bytes, bytes]]:
        """From the bottom up, the siblings before and after the path from leaf ``at``, joined."""
        found = []
        for below in self.nodes[:-1]:
            first = at - at % self.arity
            found.append((b"".join(below[first:at]), b"".join(below[at + 1 : first + self.arity])))
            at //= self.arity
        return found

    def fold(self, at: int, replacement: bytes) -> bytes:
        """The root if leaf ``at`` were ``replacement``."""
        for below, before in zip(self.nodes[:-1], self.states, strict=True):
            state = before[at].copy()
            state.update(replacement)
            for sibling in below[at + 1 : at - at % self.arity + self.arity]:
                state.update(sibling)
            replacement = state.hexdigest().encode()
            at //= self.arity
        return replacement


class Path:
    """The parents from a subtree's root to the top, each with its state before the path's slot."""

    def __init__(self, steps: list[tuple[bytes, bytes]]) -> None:
        self.steps = [(sha256(before), after) for before, after in steps]

    def fold(self, replacement: bytes) -> bytes:
        for before, after in self.steps:
            state = before.copy()
            state.update(replacement)
            state.update(after)
            replacement = state.hexdigest().encode()
        return replacement


def tree_levels(count: int, arity: int = ARITY) -> int:
    """Levels over ``count`` nodes until one is left."""
    levels = 0
    while count > 1:
        count, levels = -(-count // arity), levels + 1
    return levels


@dataclass
class Manifest:
    """Tiers of subtrees, the lowest first, of the groups' trees and of the tree over their roots.

    ``tiers`` have the columns group, subtree, count, children and node, ``levels`` levels each; ``root`` is
    null without rows.
    """

    tiers: list[DataFrame]
    top_tiers: list[DataFrame]
    levels: int
    root: str | None


def _numbered(rows: DataFrame, order: list[str], work: Workspace) -> DataFrame:
    """``rows`` (group and others) with position, from 0 in the order of ``order``, and count by group.

    Rows are range-sorted by group and order over all tasks; a row that is twice there splits as well. Each
    row then knows its place in its task, and a table with a row per task and group has the offsets.
    """
    spark = rows.sparkSession
    rows = work.keep(rows.withColumn("_row", F.monotonically_increasing_id()))
    tasks = max(1, -(-rows.count() // ROWS_PER_TASK), spark.sparkContext.defaultParallelism)
    keys = ["group", *order, "_row"]
    columns = [c for c in rows.columns if c != "_row"]
    placed = work.keep(
        rows.repartitionByRange(tasks, *keys)
        .sortWithinPartitions(*keys)
        .select(
            *columns,
            F.spark_partition_id().alias("_task"),
            F.monotonically_increasing_id().bitwiseAND((1 << _INDEX_BITS) - 1).alias("_index"),
        )
    )
    work.drop(rows)
    by_group = Window.partitionBy("group")
    before = by_group.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("group", "_task")
        .agg(F.count("*").alias("_n"), F.min("_index").alias("_first"))
        .select(
            F.col("group").alias("_group"),
            F.col("_task").alias("_of"),
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"),
            F.sum("_n").over(by_group).alias("count"),
        )
    )
    met = placed.join(offsets, (F.col("_task") == F.col("_of")) & F.col("group").eqNullSafe(F.col("_group")))
    return met.select(*columns, (F.col("_index") + F.col("_offset")).alias("position"), "count")


def _row_by_row(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as Python values, one subtree in memory at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _subtree(row: dict, below: int, levels: int) -> Subtree:
    """At most ``levels`` levels over a row's children, of a tree that has ``below`` levels under them."""
    nodes = [c["node"].encode() for c in row["children"]]
    return Subtree(nodes, min(levels, max(0, tree_levels(row["count"]) - below)))


def _tier(nodes: DataFrame, below: int, levels: int, work: Workspace) -> DataFrame:
    """Subtrees over ``nodes`` (group, count, position, node and others), with ``below`` levels under them."""
    span = ARITY**levels
    others = [c for c in nodes.columns if c not in ("group", "count", "position")]
    subtrees = nodes.groupBy("group", "count", F.expr(f"position div {span}").alias("subtree")).agg(
        F.sort_array(F.collect_list(F.struct("position", *others))).alias("children")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [_subtree(row, below, levels).root.decode() for row in _row_by_row([batch.select(["children", "count"])])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots)], names=[*batch.schema.names, "node"])

    schema = T.StructType([*subtrees.schema.fields, T.StructField("node", T.StringType())])
    return work.keep(subtrees.mapInArrow(build, schema))


def _tiers(nodes: DataFrame, levels: int, work: Workspace) -> list[DataFrame]:
    """Tiers over ``nodes`` until each group has one node left."""
    tiers = [_tier(nodes, 0, levels, work)]
    while (tiers[-1].agg(F.max("subtree")).first()[0] or 0) > 0:
        following = tiers[-1].select("group", "count", F.col("subtree").alias("position"), "node")
        tiers.append(_tier(following, levels * len(tiers), levels, work))
    return tiers


def build_manifest(rows: DataFrame, work: Workspace, levels: int = SUBTREE_LEVELS) -> Manifest:
    """The manifest of ``rows``: group, key, node (the row's digest), present (its digest as found now).

    A group's rows are ordered by key, a null key first, then by digest; groups ascend, null first. A lone
    row's digest is its group's root, a lone group's root the root of all. Rows that repeat all are leaves
    of their own.
    """
    leaves = rows.select("group", "key", "node", "present")
    numbered = _numbered(leaves, ["key", "node"], work)
    tiers = _tiers(numbered.select("group", "count", "position", "node", "key", "present"), levels, work)
    roots = tiers[-1].select(F.lit(0).alias("group"), F.col("group").alias("name"), "node")
    top = _tiers(_numbered(roots, ["name"], work), levels, work)
    found = top[-1].select("node").first()
    return Manifest(tiers, top, levels, found[0] if found else None)


_STEPS = "ARRAY<STRUCT<before: STRING, after: STRING>>"
_ARROW_STEPS = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _paths(tier: DataFrame, below: int, levels: int, keep: str) -> DataFrame:
    """From subtrees with their own ``path`` to the path of each child: group, subroot, ``keep``, path."""
    types = tier.schema["group"].dataType, tier.schema["children"].dataType.elementType[keep].dataType
    arrow_types = [to_arrow_type(t) for t in types]
    group_type, kept_type = (t.simpleString() for t in types)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _row_by_row(batches):
            tree = _subtree(row, below, levels)
            count = len(row["children"])
            paths = [
                [*({"before": a.decode(), "after": b.decode()} for a, b in tree.siblings(k)), *row["path"]]
                for k in range(count)
            ]
            columns = [
                pa.array([row["group"]] * count, type=arrow_types[0]),
                pa.array([row["subroot"]] * count, type=pa.string()),
                pa.array([c[keep] for c in row["children"]], type=arrow_types[1]),
                pa.array([c["node"] for c in row["children"]], type=pa.string()),
                pa.array(paths, type=_ARROW_STEPS),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["group", "subroot", keep, "node", "path"])

    columns = tier.select("group", "count", "children", "subroot", "path")
    return columns.mapInArrow(walk, f"group {group_type}, subroot STRING, {keep} {kept_type}, node STRING, path {_STEPS}")


def _with_paths(tier: DataFrame, paths: DataFrame) -> DataFrame:
    """Subtrees with the path and the group's root that belong to them."""
    of = paths.select(F.col("group").alias("_group"), F.col("position").alias("_subtree"), "subroot", "path")
    met = tier.join(of, (F.col("subtree") == F.col("_subtree")) & F.col("group").eqNullSafe(F.col("_group")))
    return met.drop("_group", "_subtree")


def fold_leaves(manifest: Manifest) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``proof_sha256`` digests the siblings on the way from the leaf to the root, ``folded_root`` is the root
    that the row's present digest and these siblings give, ``verified`` tells whether it is the root.
    """
    no_path = F.lit(None).cast("string").alias("subroot"), F.array().cast(_STEPS).alias("path")
    paths, levels = manifest.top_tiers[-1].select("*", *no_path), manifest.levels
    for tier in reversed(range(len(manifest.top_tiers))):
        found = _paths(paths, levels * tier, levels, "position" if tier else "name")
        paths = _with_paths(manifest.top_tiers[tier - 1], found) if tier else found
    # A group's root has the path from there on; below it, subtrees of the group's own tiers.
    position, subroot = F.lit(0).cast("bigint").alias("position"), F.col("node").alias("subroot")
    paths = paths.select(F.col("name").alias("group"), position, subroot, "path")
    subtrees = _with_paths(manifest.tiers[-1], paths)
    for tier in reversed(range(1, len(manifest.tiers))):
        subtrees = _with_paths(manifest.tiers[tier - 1], _paths(subtrees, levels * tier, levels, "position"))
    root = manifest.root
    names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _row_by_row(batches):
            tree, children = _subtree(row, 0, levels), row["children"]
            steps = [(s["before"].encode(), s["after"].encode()) for s in row["path"]]
            above, path = b"".join(a + b for a, b in steps), Path(steps)
            proofs, folded = [], []
            for k, child in enumerate(children):
                own = b"".join(a + b for a, b in tree.siblings(k))
                proofs.append(sha256(own + above).hexdigest())
                folded.append(path.fold(tree.fold(k, child["present"].encode())).decode())
            columns = [
                pa.array([c["key"] for c in children], type=pa.int64()),
                pa.array([c["node"] for c in children]),
                pa.array([row["subroot"]] * len(children)),
                pa.array([root] * len(children)),
                pa.array(proofs),
                pa.array(folded),
                pa.array([f == root for f in folded]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    texts = ", ".join(f"{n} STRING" for n in names[1:-1])
    return subtrees.select("count", "children", "subroot", "path").mapInArrow(fold, f"key BIGINT, {texts}, verified BOOLEAN")


def table_manifest(
    documents: DataFrame,
    work: Workspace,
    *,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "lang",
    present: dict[str, Column] | None = None,
    changed: Column | None = None,
    levels: int = SUBTREE_LEVELS,
) -> Manifest:
    """The manifest of ``documents`` over ``columns``; every text is hashed whole, in one scan.

    ``present`` replaces columns by what is found now in the rows for which ``changed`` holds; elsewhere
    the digest found now is the row's own. Nulls have a digest of their own, an empty text another; other
    columns do not count. An empty table has no root.
    """
    values = {c: F.col(c) for c in columns}
    node = leaf_digest(list(values.values()))
    now = node
    if present:
        now = F.when(changed, leaf_digest(list((values | present).values()))).otherwise(node)
    rows = documents.select(
        F.col(group).alias("group"), F.col(key).cast("bigint").alias("key"), node.alias("node"), now.alias("present")
    )
    return build_manifest(rows, work, levels)
