"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets the signs of its projections on random directions, several hashes of
them one after the other, and all vectors are ordered by label and these bits. Each is compared with
a bounded number of neighbours in that order; pairs that are similar enough are joined over all
passes. Equal vectors become one class before, so copies cost one row each. Since a link never leaves
a group joined so far, the exact number of links of each vector is counted afterwards within the
groups, block against block, without listing pairs.

Where vectors crowd, a window is not enough: a pair may share its first bits with more vectors than the
window holds. Runs of vectors with the same first bits that are longer than the window are therefore
finished block against block. Two vectors at the threshold agree in a bit with a chance of at least
0.936, whatever lies around them, so all passes miss the run of such a pair with a chance of less than
one in a hundred. Where a label is so dense that its runs hold more pairs than the label itself, the whole
label is finished that way instead, once and exactly. Tasks return a spanning forest of the links that
they find, no more than one link per vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.layout.positions import number_rows
from velograph.llm.common import Workspace, connected_components

SIMILARITY = 0.98
PASSES = 16
HASHES = 4
HASH_BITS = 15
WINDOW = 64
# First bits that the vectors of a run share.
RUN_BITS = 20
# Vectors of a group that one task compares with as many others: to count links, and to find them.
BLOCK = 512
PAIR_BLOCK = 8192
# Similarities that are in memory at a time.
_SIMILARITIES = 4 << 20


def _unit(vectors: list) -> np.ndarray:
    """Rows of unit length in double precision."""
    rows = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    # Scaled first, so that squares of very large or small components stay finite.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(vector: str) -> F.Column:
    """Neither null nor zero, without null or non-finite components."""
    fine = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast("double"))
    )
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _projection_keys(classes: DataFrame, passes: int, seed: int) -> DataFrame:
    """For each pass the class with its label, size and bits, as one integer that sorts like them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding").to_pylist()
            sizes = np.array([len(v) for v in vectors])
            keys = np.empty((batch.num_rows, passes), dtype=np.int64)
            for size in np.unique(sizes):
                own = np.flatnonzero(sizes == size)
                unit = _unit([vectors[k] for k in own])
                rng = np.random.default_rng([seed, int(size)])
                for k in range(passes):
                    bits = unit @ rng.standard_normal((size, HASHES * HASH_BITS)) > 0
                    keys[own, k] = bits @ (1 << np.arange(HASHES * HASH_BITS, dtype=np.int64)[::-1])
            each = np.repeat(np.arange(batch.num_rows), passes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rep").take(pa.array(each)),
                    batch.column("label").take(pa.array(each)),
                    pa.array(sizes[each].astype(np.int64)),
                    pa.array(np.tile(np.arange(passes, dtype=np.int32), batch.num_rows)),
                    pa.array(keys.ravel()),
                ],
                names=["rep", "label", "size", "pass", "bits"],
            )

    kinds = {f: classes.schema[f].dataType.simpleString() for f in ("rep", "label")}
    return classes.mapInArrow(
        work, f"rep {kinds['rep']}, label {kinds['label']}, size BIGINT, pass INT, bits BIGINT"
    )


class _Forest:
    """Links between numbered vectors that join what no link before has joined."""

    def __init__(self, count: int) -> None:
        self.roots = np.arange(count)
        self.links: list[tuple[int, int]] = []

    def add(self, linked: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> None:
        """Take up a matrix of links between the vectors ``rows`` and ``columns``."""
        while True:
            apart = linked & (self.roots[rows][:, None] != self.roots[columns][None, :])
            own, other = np.flatnonzero(apart.any(axis=1)), np.flatnonzero(apart.any(axis=0))
            if not len(own):
                return
            # Each row's first link and each column's: what they leave apart is looked at again.
            found = [*zip(rows[own], columns[apart[own].argmax(axis=1)], strict=True)]
            found += zip(rows[apart[:, other].argmax(axis=0)], columns[other], strict=True)
            parent = dict.fromkeys(self.roots.tolist())
            parent = {k: k for k in parent}

            def top(k: int, parent: dict[int, int] = parent) -> int:
                while parent[k] != k:
                    parent[k] = k = parent[parent[k]]
                return k

            for u, v in found:
                a, b = top(int(self.roots[u])), top(int(self.roots[v]))
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    self.links.append((int(u), int(v)))
            self.roots = np.array([top(k) for k in self.roots.tolist()])

    def table(self, reps: np.ndarray) -> pd.DataFrame:
        links = np.array(self.links, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": reps[links[:, 0]], "v": reps[links[:, 1]]})


def _window_links(rows: pd.DataFrame, window: int, least: float) -> pd.DataFrame:
    """Links at most ``window`` places apart, the later one in the block itself, as a spanning forest."""
    rows = rows.sort_values("position").reset_index(drop=True)
    place, own = rows["position"].to_numpy(), rows["own"].to_numpy()
    reps, number = np.unique(rows["rep"].to_numpy(), return_inverse=True)
    forest = _Forest(len(reps))
    for _, part in rows.groupby(["pass", "label", "size"], sort=False):
        at = part.index.to_numpy()
        unit = _unit(rows["embedding"].iloc[at].tolist())
        near = np.abs(place[at][:, None] - place[at][None, :]) <= window
        forest.add(np.tril(unit @ unit.T >= least, -1) & near & own[at][:, None], number[at], number[at])
    return forest.table(reps)


def _pair_links(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links between the vectors of two blocks, or within one, as a spanning forest."""
    within = rows["a"].iloc[0] == rows["b"].iloc[0]
    left = np.flatnonzero(rows["side"] == 0)
    right = left if within else np.flatnonzero(rows["side"] == 1)
    unit, forest = _unit(rows["embedding"].tolist()), _Forest(len(rows))
    step = max(1, _SIMILARITIES // max(1, len(right)))
    for first in range(0, len(left), step):
        some = left[first : first + step]
        linked = unit[some] @ unit[right].T >= least
        if within:
            linked &= some[:, None] > right[None, :]
        forest.add(linked, some, right)
    return forest.table(rows["rep"].to_numpy())


def _crowded(keys: DataFrame, classes: DataFrame, window: int) -> DataFrame:
    """Groups to be finished block against block: label, size, pass, prefix, n; a whole label has pass -1."""
    prefix = F.shiftright("bits", HASHES * HASH_BITS - RUN_BITS).alias("prefix")
    runs = keys.groupBy("label", "size", "pass", prefix).agg(F.count("*").alias("n")).where(F.col("n") > window)
    pairs = F.col("n").cast("double") * F.col("n")
    labels = classes.groupBy("label", F.size("embedding").cast("bigint").alias("size")).agg(F.count("*").alias("n"))
    spent = runs.groupBy("label", "size").agg(F.sum(pairs).alias("spent"))
    labels = labels.join(spent, ["label", "size"]).withColumn("dense", F.col("spent") >= pairs)
    whole = labels.where("dense").select("label", "size", F.lit(-1).alias("pass"), F.lit(0).cast("bigint").alias("prefix"), "n")
    sparse = labels.where("NOT dense").select("label", "size")
    return whole.unionByName(runs.join(sparse, ["label", "size"]))


def _crowd_links(crowds: DataFrame, keys: DataFrame, classes: DataFrame, least: float, block: int) -> DataFrame:
    """The links within crowded groups, cut into blocks that each meet each other in a task of their own."""
    prefix = F.shiftright("bits", HASHES * HASH_BITS - RUN_BITS)
    in_runs = keys.withColumn("prefix", prefix).join(crowds.where("pass >= 0"), ["label", "size", "pass", "prefix"])
    names = ["label", "size", "pass", "prefix"]
    in_labels = classes.select("rep", "label", F.size("embedding").cast("bigint").alias("size"))
    in_labels = in_labels.join(crowds.where("pass < 0"), ["label", "size"])
    members = in_runs.select(*names, "n", "rep").unionByName(in_labels.select(*names, "n", "rep"))
    members = members.join(classes.select("rep", "embedding"), "rep")
    members = members.withColumn("blocks", F.ceil(F.col("n") / block))
    members = members.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("theirs")
    dealt = members.select(*names, "rep", "embedding", "mine", each)
    dealt = dealt.select(
        *names,
        "rep",
        "embedding",
        F.least("mine", "theirs").alias("a"),
        F.greatest("mine", "theirs").alias("b"),
        F.when(F.col("mine") <= F.col("theirs"), 0).otherwise(1).alias("side"),
    )
    kind = classes.schema["rep"].dataType.simpleString()
    return dealt.groupBy(*names, "a", "b").applyInPandas(lambda rows: _pair_links(rows, least), f"u {kind}, v {kind}")


def _block_links(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Number of linked vectors that each class of one block has among those of the other."""
    left, right = rows[rows["side"] == 0], rows[rows["side"] == 1]
    if left.empty or right.empty:
        return pd.DataFrame({"rep": rows["rep"].iloc[:0], "others": np.empty(0, dtype=np.int64)})
    linked = _unit(left["embedding"].tolist()) @ _unit(right["embedding"].tolist()).T >= least
    linked &= left["rep"].to_numpy()[:, None] != right["rep"].to_numpy()[None, :]
    return pd.DataFrame({"rep": left["rep"], "others": linked @ right["copies"].to_numpy()})


def near_duplicate_vectors(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    similarity: float = SIMILARITY,
    passes: int = PASSES,
    window: int = WINDOW,
    block: int = BLOCK,
    pair_block: int = PAIR_BLOCK,
    seed: int = 13,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (least id reachable by links), kept.

    Only vectors with equal labels, not null, and of equal length are compared. Vectors that are null
    or zero or hold null or non-finite components link with nothing, as does a row without id, which
    has no component. Equal rows count as vectors of their own; an id is expected to have one vector.
    Other columns are not read. Without rows there are none.

    A pair at the threshold is missed with a chance of less than one in a hundred, in a dense label with
    none; pairs that are more similar are missed less. Crowded runs and dense labels take time in
    proportion to the square of their different vectors, in blocks of ``pair_block``.
    """
    work = Workspace(vectors.sparkSession)
    source = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"), F.col(label).alias("label")
    )
    # Minus zero is zero.
    source = source.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0).cast("float")))
    able = source.where(usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    same = ["label", "embedding"]
    classes = work.keep(able.groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))

    keys = work.keep(_projection_keys(classes, passes, seed))
    placed = number_rows(keys, ["pass", "label", "size", "bits", "rep"], ["rep", "label", "size", "pass"])
    width = 4 * window
    here = F.floor((F.col("position") - 1) / width)
    # Each block also sees the last rows of the one before it.
    shown = placed.withColumn("block", here).withColumn("own", F.lit(True))
    tail = (F.col("position") - 1) % width >= width - window
    shown = shown.unionByName(shown.where(tail).withColumn("block", F.col("block") + 1).withColumn("own", F.lit(False)))
    kind = classes.schema["rep"].dataType.simpleString()
    in_windows = (
        shown.join(classes.select("rep", "embedding"), "rep")
        .groupBy("block")
        .applyInPandas(lambda rows: _window_links(rows, window, similarity), f"u {kind}, v {kind}")
    )
    crowds = work.keep(_crowded(keys, classes, window))
    in_crowds = _crowd_links(crowds, keys, classes, similarity, pair_block)
    links = work.keep(in_windows.unionByName(in_crowds).distinct())
    work.drop(keys, crowds)
    stars = connected_components(links, work)
    work.drop(links)
    component = F.coalesce("component", "rep")
    grouped = classes.join(stars, classes["rep"] == stars["id"], "left").select(
        "rep", "embedding", "copies", component.alias("component")
    )
    grouped = work.keep(grouped)
    groups = work.keep(
        grouped.groupBy("component")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("component", F.ceil(F.col("n") / block).alias("blocks"))
    )
    dealt = grouped.join(groups, "component").withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("theirs")
    fields = ["component", "rep", "embedding", "copies"]
    left = dealt.select(*fields, F.col("mine").alias("a"), each, F.lit(0).alias("side")).withColumnRenamed("theirs", "b")
    right = dealt.select(*fields, F.col("mine").alias("b"), each, F.lit(1).alias("side")).withColumnRenamed("theirs", "a")
    counted = (
        left.unionByName(right)
        .groupBy("component", "a", "b")
        .applyInPandas(lambda rows: _block_links(rows, similarity), f"rep {kind}, others BIGINT")
        .groupBy("rep")
        .agg(F.sum("others").alias("others"))
    )
    facts = work.keep(
        grouped.join(counted, "rep", "left").select("rep", "copies", "component", F.coalesce("others", F.lit(0)).alias("others"))
    )
    by_class = classes.select("rep", *same).join(facts, "rep").select(*same, "copies", "component", "others")
    by_class = work.keep(by_class)
    work.drop(stars, grouped, groups, facts, classes)
    linked = source.withColumn("able", usable("embedding") & F.col("vec_id").isNotNull()).alias("s").join(
        by_class.alias("c"),
        F.col("able") & (F.col("s.label") == F.col("c.label")) & (F.col("s.embedding") == F.col("c.embedding")),
        "left",
    )
    component_id = F.coalesce("component", "vec_id")
    return linked.select(
        "vec_id",
        F.coalesce(F.col("copies") - 1 + F.col("others"), F.lit(0)).alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), component_id).alias("component_id"),
        F.col("vec_id").eqNullSafe(component_id).alias("kept"),
    )
