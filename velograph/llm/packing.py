"""Packing of documents into sequences by Karmarkar-Karp multiway differencing.

Each task reads its documents once. Whole windows are cut off a document's front and fill sequences
of their own; what is left is cut into pieces and gathered until there is enough for some dozens of
windows. Differencing then merges partial partitions, the two most uneven first, the largest sums of
one with the smallest of the other, until one is left: near-equal windows. If one of them exceeds the
capacity, the number of windows rises by one and the merging starts again. Only what each task has
left over at its end is shuffled, to be packed together with its neighbours' rest.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velograph.llm import bytepairs
from velograph.llm.common import Workspace

CAPACITY = 2048
END_ID = 1
# Longest piece of a document's rest, and windows that are packed together.
PIECE_TOKENS = 512
WINDOWS_PER_GROUP = 128

_ROW_BITS = 40
_TAIL_MARK = 1 << 62
_NAMES = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def differencing(lengths: np.ndarray, windows: int) -> np.ndarray:
    """The window, 0 to ``windows`` - 1, of each length, by largest differencing."""
    if windows == 1:
        return np.zeros(len(lengths), dtype=np.int64)
    heap: list[tuple[int, int]] = []
    sums: list[np.ndarray | None] = []
    merged: dict[int, tuple[int, int, np.ndarray]] = {}
    for k, length in enumerate(lengths.tolist()):
        own = np.zeros(windows, dtype=np.int64)
        own[0] = length
        sums.append(own)
        heap.append((-length, k))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        together = sums[a] + sums[b][::-1]
        order = np.argsort(-together, kind="stable")
        together = together[order]
        together -= together[-1]
        merged[len(sums)] = (a, b, order)
        sums[a] = sums[b] = None
        heapq.heappush(heap, (-int(together[0]), len(sums)))
        sums.append(together)
    window = np.zeros(len(lengths), dtype=np.int64)
    labels = {heap[0][1]: np.arange(windows)}
    for node in range(len(sums) - 1, -1, -1):
        own = labels.pop(node)
        if node < len(lengths):
            window[node] = own[0]
            continue
        a, b, order = merged[node]
        labels[a] = left = np.empty(windows, dtype=np.int64)
        labels[b] = right = np.empty(windows, dtype=np.int64)
        left[order] = own
        right[windows - 1 - order] = own
    return window


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece; no piece may exceed the capacity, and no window does."""
    windows = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        window = differencing(lengths, windows)
        if np.bincount(window, weights=lengths).max(initial=0) <= capacity:
            break
        windows += 1
    order = np.argsort(window, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    opens = np.r_[True, window[order][1:] != window[order][:-1]]
    offset = np.empty(len(lengths), dtype=np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(opens, before, 0))
    return window, offset


def cut_points(tokens: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: whole windows, then smaller ones, then the remainder."""
    whole = tokens - tokens % capacity
    starts = [*range(0, whole, capacity), *range(whole, tokens, piece)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], tokens], strict=True)]


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    piece_tokens: int = PIECE_TOKENS,
    windows_per_group: int = WINDOWS_PER_GROUP,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the id, start, length, ids_crc32, doc_tokens, sequence_id, offset, [ids].

    A null or empty text is the end id alone. Equal rows are packed each on their own, a null id is
    kept. Other columns are not read. Without rows there are no pieces. A document's ids are cut
    wherever that fills windows; each id lies in one piece, and offsets in a sequence have no gap.
    """
    names = [*_NAMES, "group", *(["ids"] if with_ids else [])]
    source = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, start BIGINT, length BIGINT, ids_crc32 BIGINT, doc_tokens BIGINT, sequence_id BIGINT, offset BIGINT, group BIGINT" + (
        ", ids ARRAY<INT>" if with_ids else ""
    )
    ending = np.array([end_id], dtype="<u4").tobytes()
    enough = capacity * windows_per_group

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bytepairs.load(tokenizer_path).ids
        task = TaskContext.get().partitionId()
        sequences = task << _ROW_BITS
        ready: list[tuple] = []
        gathered: list[tuple] = []
        size = 0
        id_kind = None

        def packed(rows: list[tuple], first: int) -> Iterator[tuple]:
            window, offset = pack(np.array([r[2] for r in rows]), capacity)
            for row, w, o in zip(rows, window.tolist(), offset.tolist(), strict=True):
                yield (*row[:5], first + w, o, None, *row[5:])

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * (len(names) + 1)
            kinds = [id_kind, *[pa.int64()] * 7, *([pa.list_(pa.int32())] if with_ids else [])]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", *names]
            )

        for batch in batches:
            id_kind = batch.schema.field("doc_id").type
            for key, content in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(content.as_py() or "") + ending
                tokens = len(ids) // 4
                for start, length in cut_points(tokens, capacity, piece_tokens):
                    part = ids[4 * start : 4 * (start + length)]
                    row = (key, start, length, zlib.crc32(part), tokens)
                    if with_ids:
                        row = (*row, np.frombuffer(part, dtype="<u4").astype(np.int32))
                    if length == capacity:
                        ready.append((*row[:5], sequences, 0, None, *row[5:]))
                        sequences += 1
                    else:
                        gathered.append(row)
                        size += length
                if size >= enough:
                    done = list(packed(gathered, sequences))
                    sequences = max(r[5] for r in done) + 1
                    ready += done
                    gathered, size = [], 0
                if len(ready) >= 5000:
                    yield table(ready)
                    ready = []
        if ready:
            yield table(ready)
        if gathered:
            yield table([(*r[:5], None, None, task, *r[5:]) for r in gathered])

    workspace = Workspace(documents.sparkSession)
    placed = workspace.keep(source.mapInArrow(work, schema))
    rest = placed.where("sequence_id IS NULL")
    total, last = rest.agg(F.sum("length"), F.max("group")).first()
    done = placed.where("sequence_id IS NOT NULL").drop("group")
    if total is None:
        return done
    # Neighbouring tasks' leftovers share a group of about the usual size.
    groups = max(1, total // enough)
    rest = rest.withColumn("group", F.expr(f"group * {groups} div {last + 1}"))

    def pack_rest(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "start", "length", "ids_crc32"], kind="stable").reset_index(drop=True)
        window, offset = pack(rows["length"].to_numpy(dtype=np.int64), capacity)
        rows["sequence_id"] = _TAIL_MARK + (int(rows["group"].iloc[0]) << _ROW_BITS >> 8) + window
        rows["offset"] = offset
        return rows.drop(columns="group")

    out = done.schema
    packed_rest = rest.repartitionByRange(int(groups), "group").groupBy("group").applyInPandas(pack_rest, out)
    return done.unionByName(packed_rest)
