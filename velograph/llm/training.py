"""Bounded, reproducible samples of labelled documents, and calibration of scores on them."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from itertools import chain
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.llm.common import crc32_fold, slices

HELD_OUT = 2


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, rows_per_class: int, extra: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, text, target and ``extra`` of at most ``rows_per_class`` labelled documents of each class.

    The rows with the smallest hash of the id are taken, none of them held out; the choice does not
    depend on the layout. Rows that lack an id, a text or a label are not learned from, and an id
    with several texts counts once, with the least of them.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("target")).dropna()
    known = known.where(crc32_fold("doc_id") != HELD_OUT).groupBy("doc_id").agg(F.max("target").alias("target"))
    order = F.xxhash64("doc_id")
    chosen = [known.where(F.col("target") == k).orderBy(order, "doc_id").limit(rows_per_class) for k in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    # At most two rows_per_class rows of two integers: bounded, hence the broadcast.
    kept = documents.select("doc_id", "text", *extra).dropna(subset=["doc_id", "text"])
    picked = kept.join(F.broadcast(chosen), "doc_id")
    return picked.groupBy("doc_id").agg(
        F.min("text").alias("text"), F.first("target").alias("target"), *(F.min(c).alias(c) for c in extra)
    )


def fit_in_one_task(sample: DataFrame, prepare: Callable[[pa.RecordBatch], list[Any]], fit: Callable[[list[Any]], Any]) -> Any:
    """Learn from a bounded sample in one task; only what ``fit`` returns comes to the driver.

    ``prepare`` turns some rows into one entry each, ``fit`` gets the entries of all rows, by doc_id.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries: list[tuple] = []
        for batch in chain.from_iterable(slices(b, "text", 1 << 18) for b in batches):
            entries += zip(batch.column("doc_id").to_pylist(), prepare(batch), strict=True)
        entries.sort(key=lambda e: e[0])
        yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(fit([e for _, e in entries]))]})

    row = sample.repartition(1).mapInArrow(work, "model BINARY").first()
    return pickle.loads(row[0]) if row else fit([])


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(values, -500, 500)))


def best_threshold(logits: np.ndarray, targets: np.ndarray, clean: int, clean_weight: float = 0.7) -> float:
    """The middle of the widest gap among the cuts that are about the best.

    A cut is judged by the shares of both classes that it gets right, where the documents of class
    ``clean``, which are to be left alone, weigh more; cuts within a hundredth of the best count
    alike. With one class only, or no rows, there is nothing to choose and the cut is 0.
    """
    positive = int(targets.sum())
    if not 0 < positive < len(targets):
        return 0.0
    order = np.argsort(logits, kind="stable")
    values, ones = logits[order], targets[order]
    # Cut k calls the first k rows negative, for k from 1.
    below_zero = np.cumsum(1 - ones)[:-1] / (len(ones) - positive)
    above_one = (positive - np.cumsum(ones)[:-1]) / positive
    right = clean_weight * (above_one if clean else below_zero) + (1 - clean_weight) * (below_zero if clean else above_one)
    gaps = np.diff(values)
    right = np.where(gaps > 0, right, -1)
    best = np.flatnonzero(right >= right.max() - 0.01)
    k = best[np.argmax(gaps[best])]
    return float((values[k] + values[k + 1]) / 2)


def shifted(logits: np.ndarray, threshold: float | np.ndarray, cut: float) -> np.ndarray:
    """Scores from 0 to 1 that are at least ``cut`` exactly where the logit reaches the threshold."""
    return np.clip(sigmoid(logits - threshold + np.log(cut / (1 - cut))), 0.0, 1.0)
