"""Supervised subword embeddings: hashed word and character n-gram vectors, averaged per document.

A document's vector is the mean of the learned vectors of its words, word pairs and byte n-grams, and
a softmax layer turns it into class probabilities. Training is stochastic gradient descent in numpy
on a bounded sample of labelled documents, in one task. For scoring, the
product of each vector with the output layer is one number per hash bucket, so a task reads each text
once and averages looked-up numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from velograph.llm.common import joined, mix, slices, texts_of, word_hashes, word_spans
from velograph.llm.training import best_threshold, fit_in_one_task, labelled_sample, shifted

# Labelled documents of each class that are learned from, at most.
SAMPLE_PER_CLASS = 1500
BUCKET_BITS = 17
DIMENSIONS = 8
EPOCHS = 12
RATE = 0.5
# The share of the sample that the threshold is chosen on; it is not trained on.
CALIBRATION_SHARE = 0.25
CUT = 0.7
NGRAM_SIZES = (3, 5)

# Words are runs of anything but ASCII white space.
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_SEPARATOR = 0x0A
_PAIR = np.uint64(0xA0761D6478BD642F)
_REPEATED = np.uint64(0xE7037ED1A0B428DB)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of all texts, and the text that each one belongs to.

    A text's features are its words, its pairs of neighbouring words (a repeated word counts as one
    kind of pair) and the byte n-grams within it; an empty text has none.
    """
    buffer, begins = joined(texts, _SEPARATOR)
    starts, ends = word_spans(buffer, _IS_WORD)
    words = word_hashes(buffer, starts, ends)
    owner = np.searchsorted(begins, starts, "right") - 1
    pairs = mix(words[:-1] * _PAIR + words[1:])
    pairs[words[:-1] == words[1:]] = _REPEATED
    within = owner[:-1] == owner[1:]
    hashes, owners = [words, pairs[within]], [owner, owner[1:][within]]
    place = np.repeat(np.arange(len(texts)), np.diff(begins))
    for size in NGRAM_SIZES:
        code = np.zeros(max(len(buffer) - size, 0), dtype=np.uint64)
        for k in range(size):
            code = (code << np.uint64(8)) | buffer[k : k + len(code)]
        # buffer[1:] holds the texts, each followed by a separator.
        code, of = code[1:], place[: max(len(code) - 1, 0)]
        same = of == place[size - 1 : size - 1 + len(of)]
        tail = np.zeros(len(place), dtype=bool)
        tail[begins[1:] - 2] = True
        inside = same & ~tail[size - 1 : size - 1 + len(of)]
        hashes.append(mix(code[inside] + np.uint64(size << 56)))
        owners.append(of[inside])
    buckets = np.concatenate(hashes) >> np.uint64(64 - BUCKET_BITS)
    return buckets.astype(np.int64), np.concatenate(owners)


@dataclass
class SubwordModel:
    """One number per bucket: how much its vector speaks for class 1; bias and threshold as logits."""

    weights: np.ndarray
    bias: float
    threshold: float

    def logits(self, texts: list[bytes]) -> np.ndarray:
        with np.errstate(over="ignore"):
            buckets, owner = features(texts)
        total = np.bincount(owner, weights=self.weights[buckets], minlength=len(texts))
        count = np.bincount(owner, minlength=len(texts))
        return total / np.maximum(count, 1) + self.bias

    def scores(self, texts: list[bytes], cut: float = CUT) -> np.ndarray:
        return shifted(self.logits(texts), self.threshold, cut)


def _sparse_features(batch: pa.RecordBatch) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Target, distinct buckets and their shares of each text's features."""
    with np.errstate(over="ignore"):
        buckets, owner = features(texts_of(batch, "text"))
    keys, counts = np.unique(owner * (1 << BUCKET_BITS) + buckets, return_counts=True)
    cuts = np.searchsorted(keys >> BUCKET_BITS, np.arange(batch.num_rows + 1))
    keys = (keys & ((1 << BUCKET_BITS) - 1)).astype(np.int32)
    rows = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    shares = [(counts[r] / max(counts[r].sum(), 1)).astype(np.float32) for r in rows]
    return list(zip(batch.column("target").to_pylist(), (keys[r] for r in rows), shares, strict=True))


def descend(
    documents: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, seed: int = 7
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket vectors, output layer and its bias, by gradient steps over single documents.

    A step on the vectors is divided by the squared norm of the document's feature shares, so that it
    moves the document's mean by the same amount however long the text is.
    """
    rng = np.random.default_rng(seed)
    vectors = (rng.standard_normal((1 << BUCKET_BITS, DIMENSIONS)) / DIMENSIONS).astype(np.float32)
    output = np.zeros((DIMENSIONS, 2), dtype=np.float32)
    output[:] = rng.standard_normal((DIMENSIONS, 2)) / np.sqrt(DIMENSIONS)
    bias = np.zeros(2, dtype=np.float32)
    balance = len(targets) / (2 * np.maximum(np.bincount(targets, minlength=2), 1))
    steps = EPOCHS * len(documents)
    for step, k in enumerate(np.concatenate([rng.permutation(len(documents)) for _ in range(EPOCHS)])):
        buckets, shares = documents[k]
        if not len(buckets):
            continue
        rate = np.float32(RATE * (1 - step / steps))
        own = vectors[buckets]
        mean = shares @ own
        logits = mean @ output + bias
        chance = np.exp(logits - logits.max())
        chance /= chance.sum()
        chance[targets[k]] -= 1
        error = (chance * balance[targets[k]]).astype(np.float32)
        back = output @ error
        output -= rate * np.outer(mean, error)
        bias -= rate * error * np.float32(0.1)
        vectors[buckets] = own - (rate * shares / (shares @ shares))[:, None] * back
    return vectors, output, bias


def train(
    documents: DataFrame, labels: DataFrame, label: str = "quality", *, rows_per_class: int = SAMPLE_PER_CLASS
) -> SubwordModel:
    """Learn ``label`` (0 or 1) from a bounded sample; without labelled rows every score is the cut."""
    return fit_in_one_task(labelled_sample(documents, labels, label, rows_per_class), _sparse_features, _fit)


def _fit(entries: list[tuple[int, np.ndarray, np.ndarray]]) -> SubwordModel:
    if not entries:
        return SubwordModel(np.zeros(1 << BUCKET_BITS, dtype=np.float32), 0.0, 0.0)
    targets = np.array([t for t, _, _ in entries], dtype=np.int64)
    data = [(b, s) for _, b, s in entries]
    order = np.random.default_rng(11).permutation(len(data))
    held = order[: int(len(data) * CALIBRATION_SHARE)]
    learned = np.setdiff1d(order, held)
    vectors, output, bias = descend([data[k] for k in learned], targets[learned])
    weights = vectors @ (output[:, 1] - output[:, 0])
    model = SubwordModel(weights, float(bias[1] - bias[0]), 0.0)
    logits = np.array([s @ weights[b] for b, s in (data[k] for k in held)]) + model.bias
    model.threshold = best_threshold(logits, targets[held], clean=1)
    return model


def score(
    documents: DataFrame, model: SubwordModel, *, text: str = "text", result: str = "quality_score", cut: float = CUT
) -> DataFrame:
    """``documents`` with a column ``result``, from 0 to 1; at least ``cut`` means class 1.

    A null text scores as an empty one. An input column called ``result`` is replaced; all other
    columns pass through, equal rows each get the same score.
    """
    source = documents.drop(result)
    shared = source.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*source.schema.fields, T.StructField(result, T.DoubleType())])
    names = source.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, text) for b in batches):
            found = shared.value.scores(texts_of(batch, text), cut)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*names, result])

    return source.mapInArrow(work, schema)
