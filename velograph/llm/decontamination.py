"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The test strings are the windows of the benchmark items, cut to words. For each window length there
is a shift table over blocks of up to three words: the block under the reading position tells how far
the search may move on without missing a window. Where the shift is zero, the bucket of the windows that
end in that block is taken, and each of them is compared with the text, first by word hashes, then
byte by byte. The documents are scanned once, without a shuffle.

Tasks build the tables, each for some items, and write them to the folder that all executors share; the
driver knows their paths only. A window is a place in its items' words, so tables take some ten bytes for
each of the items' text, and a shift table has slots in proportion to its blocks, so that most are empty
whatever the size of the benchmark.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterator
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from velograph.llm.common import (
    Workspace,
    file_system,
    joined,
    lower_ascii,
    mix,
    slices,
    texts_of,
    word_hashes,
    word_spans,
)

WINDOW_WORDS = 13
# Item text that goes into one set of tables, and bytes of tables that a task holds at a time.
BLOCK_BYTES = 4 << 20
HELD_BYTES = 256 << 20

_LOWER = lower_ascii()
# Digits, letters and every byte of a character past ASCII make up words.
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_SEPARATOR = 0x20
_BLOCK_WORDS = 3
_SLOTS_PER_BLOCK = 8
_LEAST_BITS = 10
_LANE_WORDS = 64
# Document text that is searched for one set of tables after the other.
_CHUNK_BYTES = 32 << 20
_ARRAYS = ("starts", "suffix", "shift", "item_bounds", "items")
_NO_SPANS = np.empty((0, 2), dtype=np.int64)
_BLOCK_FACTOR = np.uint64(0x9FB21C651E98DF25)

_RESULT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ]
)
_RESULT_TYPE = from_arrow_type(_RESULT)


def words_of(text: bytes) -> list[bytes]:
    """The words of one text, lower-cased."""
    buffer, _ = joined([text], _SEPARATOR)
    lowered = _LOWER[buffer]
    return [lowered[a:b].tobytes() for a, b in zip(*word_spans(lowered, _IS_WORD), strict=True)]


class _Windows:
    """The windows of one length: shift table, suffix buckets and the items that hold each window.

    Made by ``build`` as plain arrays, which are written, and read by the search.
    """

    def __init__(self, length: int, words: np.ndarray, arrays: dict[str, np.ndarray]) -> None:
        self.length, self.block, self.words = length, min(_BLOCK_WORDS, length), words
        self.starts, self.suffix, self.shift = arrays["starts"], arrays["suffix"], arrays["shift"]
        self.item_bounds, self.items = arrays["item_bounds"], arrays["items"]
        self.bits = int(len(self.shift)).bit_length() - 1

    @staticmethod
    def blocks(words: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
        """A hash of the ``size`` words up to each place."""
        value = words[end]
        for back in range(1, size):
            value = value * _BLOCK_FACTOR + words[end - back]
        return mix(value)

    @classmethod
    def build(cls, length: int, words: np.ndarray, starts: np.ndarray, owners: np.ndarray) -> dict[str, np.ndarray]:
        """The arrays for the windows at ``starts`` of ``words``, which belong to the items ``owners``."""
        size = min(_BLOCK_WORDS, length)
        suffix = cls.blocks(words, starts + length - 1, size)
        # Equal windows become one: two hashes over all words tell them apart.
        whole = [cls.blocks(words if k else words ^ np.uint64(0xA5A5), starts + length - 1, length) for k in range(2)]
        order = np.lexsort((owners, whole[1], whole[0], suffix))
        starts, owners, suffix, whole = starts[order], owners[order], suffix[order], [w[order] for w in whole]
        opens = np.r_[True, (whole[0][1:] != whole[0][:-1]) | (whole[1][1:] != whole[1][:-1])]
        again = np.r_[False, ~opens[1:] & (owners[1:] == owners[:-1])]
        first = np.flatnonzero(opens)
        bounds = np.r_[0, np.cumsum(~again)][np.r_[first, len(opens)]]
        ends = np.unique((starts[first, None] + np.arange(size - 1, length)).ravel()) if len(first) else first
        bits = max(_LEAST_BITS, int(_SLOTS_PER_BLOCK * max(len(ends), 1) - 1).bit_length())
        shift = np.full(1 << bits, length - size + 1, dtype=np.uint8 if length < 256 else np.int32)
        for end in range(size - 1, length):
            slot = cls.blocks(words, starts[first] + end, size) >> np.uint64(64 - bits)
            np.minimum.at(shift, slot, length - 1 - end)
        kept = owners[~again].astype(np.int32)
        return {"starts": starts[first], "suffix": suffix[first], "shift": shift, "item_bounds": bounds, "items": kept}

    def search(self, words: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last word and window of each likely occurrence in the documents first..last of ``words``."""
        counts = np.maximum(last - first - self.length + 1, 0)
        lanes = -(-counts // _LANE_WORDS)
        lane_no = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = np.repeat(first + self.length - 1, lanes) + lane_no * _LANE_WORDS
        stop = np.minimum(at + _LANE_WORDS, np.repeat(last, lanes))
        found = []
        while len(at):
            block = self.blocks(words, at, self.block)
            shift = self.shift[block >> np.uint64(64 - self.bits)].astype(np.int64)
            hit = shift == 0
            if hit.any():
                found.append((at[hit], block[hit]))
            at = at + np.maximum(shift, 1)
            running = at < stop
            at, stop = at[running], stop[running]
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        ends, block = (np.concatenate(x) for x in zip(*found, strict=True))
        low = np.searchsorted(self.suffix, block, "left")
        size = np.searchsorted(self.suffix, block, "right") - low
        ends, low = np.repeat(ends, size), np.repeat(low, size)
        window = low + np.arange(len(low)) - np.repeat(np.cumsum(size) - size, size)
        for place in range(self.length):
            same = words[ends - self.length + 1 + place] == self.words[self.starts[window] + place]
            ends, window = ends[same], window[same]
        return ends, window


class Patterns:
    """All windows of some items, by length."""

    def __init__(self, stored: dict[str, np.ndarray]) -> None:
        self.text, self.names = stored["text"].tobytes(), json.loads(stored["names"].tobytes())
        self.begins, self.ends = stored["word_starts"], stored["word_ends"]
        self.groups = [
            _Windows(n, stored["words"], {k: stored[f"{n}_{k}"] for k in _ARRAYS}) for n in stored["lengths"].tolist()
        ]

    @staticmethod
    def build(items: list[tuple[str, bytes]], window: int = WINDOW_WORDS) -> dict[str, np.ndarray]:
        """The arrays of all windows of ``items``, for the constructor."""
        buffer, begins = joined([text for _, text in items], _SEPARATOR)
        lowered = _LOWER[buffer]
        starts, ends = word_spans(lowered, _IS_WORD)
        with np.errstate(over="ignore"):
            words = word_hashes(lowered, starts, ends)
            bounds = np.searchsorted(starts, begins)
            counts = np.diff(bounds)
            lengths = np.minimum(counts, window)
            stored = {"text": lowered, "word_starts": starts, "word_ends": ends, "words": words}
            stored["names"] = np.frombuffer(json.dumps([name for name, _ in items]).encode(), dtype=np.uint8)
            stored["lengths"] = np.unique(lengths[lengths > 0])
            for length in stored["lengths"].tolist():
                owners = np.flatnonzero(lengths == length)
                each = counts[owners] - length + 1
                owner = np.repeat(owners, each)
                place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                arrays = _Windows.build(length, words, bounds[owner] + place, owner)
                stored |= {f"{length}_{k}": v for k, v in arrays.items()}
        return stored

    def _window_text(self, group: _Windows, window: int) -> bytes:
        at = group.starts[window]
        spans = zip(self.begins[at : at + group.length], self.ends[at : at + group.length], strict=True)
        return b" ".join(self.text[a:b] for a, b in spans)

    def scan(self, texts: _Texts) -> tuple[list[np.ndarray], list[set[str]]]:
        """Per text the word spans hit, as an array of pairs, and its items."""
        words, first, last, bounds = texts.words, texts.bounds[:-1], texts.bounds[1:], texts.bounds
        change = np.zeros(len(words) + 1, dtype=np.int64)
        items: list[set[str]] = [set() for _ in first]
        for group in self.groups:
            found, windows = group.search(words, first, last)
            confirmed: dict[tuple[int, bytes], bool] = {}
            for end, window in zip(found.tolist(), windows.tolist(), strict=True):
                begin = end - group.length + 1
                part = (window, texts.raw[texts.starts[begin] : texts.ends[end]])
                if part not in confirmed:
                    confirmed[part] = b" ".join(words_of(part[1])) == self._window_text(group, window)
                if confirmed[part]:
                    change[begin] += 1
                    change[end + 1] -= 1
                    own = group.items[group.item_bounds[window] : group.item_bounds[window + 1]]
                    items[int(np.searchsorted(first, begin, "right")) - 1].update(self.names[k] for k in own.tolist())
        inside = np.cumsum(change[:-1]) > 0
        begins_text = np.zeros(len(words) + 1, dtype=bool)
        begins_text[bounds] = True
        opens = np.flatnonzero(inside & (begins_text[:-1] | ~np.r_[False, inside[:-1]]))
        closes = np.flatnonzero(inside & (begins_text[1:] | ~np.r_[inside[1:], False]))
        runs = np.stack([opens, closes + 1], axis=1)
        where = np.searchsorted(runs[:, 0], bounds)
        return [runs[a:b] - w for a, b, w in zip(where[:-1], where[1:], first, strict=True)], items


class _Texts:
    """Some texts as one run of words."""

    def __init__(self, texts: list[bytes]) -> None:
        buffer, begins = joined(texts, _SEPARATOR)
        lowered = _LOWER[buffer]
        self.starts, self.ends = word_spans(lowered, _IS_WORD)
        self.words = word_hashes(lowered, self.starts, self.ends)
        self.bounds = np.searchsorted(self.starts, begins)
        self.raw = lowered.tobytes()


def _united(spans: np.ndarray) -> list[dict[str, int]]:
    merged: list[dict[str, int]] = []
    for start, end in sorted(map(tuple, spans.tolist())):
        if merged and start <= merged[-1]["end"]:
            merged[-1]["end"] = max(merged[-1]["end"], end)
        else:
            merged.append({"start": start, "end": end})
    return merged


def write_patterns(benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int, work: Workspace) -> DataFrame:
    """Build and write the tables of all items, in blocks of about ``block_bytes`` of text: path, bytes."""
    folder = f"{work.folder}/patterns-{uuid4().hex}"
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("text")).dropna()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = file_system(folder)
        task, number, block, held = TaskContext.get(), 0, [], 0

        def written() -> pa.RecordBatch:
            stored = io.BytesIO()
            np.savez(stored, **Patterns.build(block, window))
            name = f"{task.partitionId():06d}-{number:04d}-{task.taskAttemptId()}.npz"
            with files.open_output_stream(f"{at}/{name}", compression=None) as out:
                size = out.write(stored.getvalue())
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "bytes": [size]})

        for batch in batches:
            for item, content in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                block.append((item, content))
                held += len(content)
                if held >= block_bytes:
                    yield written()
                    number, block, held = number + 1, [], 0
        if block:
            yield written()

    return work.keep(rows.mapInArrow(build, "path STRING, bytes BIGINT"))


def read_patterns(path: str) -> Patterns:
    folder, name = path.rsplit("/", 1)
    system, root = file_system(folder)
    with system.open_input_stream(f"{root}/{name}", compression=None) as stream:
        return Patterns(dict(np.load(io.BytesIO(stream.read()))))


# Tables that this process holds, of one benchmark at a time.
_held: dict[str, Patterns] = {}


def _tables(paths: list[str], hold: bool) -> Iterator[Patterns]:
    """The tables one after the other; held where all of them have room, else read each time."""
    if hold and not set(paths) <= set(_held):
        _held.clear()
        _held.update((p, read_patterns(p)) for p in paths)
    for path in paths:
        yield _held[path] if hold else read_patterns(path)


def find_benchmark_text(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    held_bytes: int = HELD_BYTES,
    result: str = "contamination",
) -> DataFrame:
    """``documents`` with a column ``result``: n_words, spans (word positions hit) and items.

    A null text has no words. An item without id or text is left out; items with the same id count
    as one. Equal rows each get their result, a text of any length is searched whole. A column already
    called ``result`` is replaced. Without items every document comes back with no spans.

    A task holds the tables in memory where all together take no more than ``held_bytes``; beyond that it
    reads them one by one for every ``_CHUNK_BYTES`` of its documents.
    """
    source = documents.drop(result)
    kept = source.columns
    work = Workspace(documents.sparkSession)
    listed = write_patterns(benchmark, item_id, item_text, window, block_bytes, work).collect()
    work_list = sorted(r["path"] for r in listed)
    hold = sum(r["bytes"] for r in listed) <= held_bytes
    schema = T.StructType([source.schema[c] for c in kept]).add(result, _RESULT_TYPE)

    def judged(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            texts = [_Texts(texts_of(part, text)) for part in parts]
            spans = [[[] for _ in range(part.num_rows)] for part in parts]
            items = [[set() for _ in range(part.num_rows)] for part in parts]
            for patterns in _tables(work_list, hold):
                for k, own in enumerate(texts):
                    for row, (span, names) in enumerate(zip(*patterns.scan(own), strict=True)):
                        spans[k][row].append(span)
                        items[k][row] |= names
        for k, part in enumerate(parts):
            counts = np.diff(texts[k].bounds).tolist()
            rows = [
                {"n_words": n, "spans": _united(np.concatenate(s) if s else _NO_SPANS), "items": sorted(i)}
                for n, s, i in zip(counts, spans[k], items[k], strict=True)
            ]
            columns = [*(part.column(c) for c in kept), pa.array(rows, type=_RESULT)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, result])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for part in chain.from_iterable(slices(b, text) for b in batches):
            parts.append(part)
            held += part.column(text).nbytes
            if hold or held >= _CHUNK_BYTES:
                yield from judged(parts)
                parts, held = [], 0
        if parts:
            yield from judged(parts)

    return source.mapInArrow(search, schema)


def contamination_columns(found: DataFrame, result: str = "contamination") -> DataFrame:
    """The digest of each document: n_words, n_hit, n_items, items_sha256 and contaminated."""
    hit = F.coalesce(
        F.aggregate(F.col(f"{result}.spans"), F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]), F.lit(0)
    )
    return (
        found.withColumn("n_words", F.col(f"{result}.n_words"))
        .withColumn("n_hit", hit)
        .withColumn("n_items", F.size(f"{result}.items").cast("bigint"))
        .withColumn("items_sha256", F.sha2(F.concat_ws(",", f"{result}.items").cast("binary"), 256))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))
    )
