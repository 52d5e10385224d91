"""Periodic runs of words, found by an online sparse dynamic program over diagonals.

A cell (word, lag) says that the word occurs ``lag`` words earlier too; along a diagonal, one lag, the
match length of a cell is that of the cell before plus one. Words are taken in order. Each word's earlier
occurrences increment the match lengths of the active lags, and a diagonal that the word does not go on
ends there: if what it matched, with the ``lag`` words before, is long enough, the run is emitted at once.

Kept sparse: a common word has very many earlier occurrences, most of which lead to no run. A word
therefore opens a lag only as the first of ``width`` words that occur again, ``width`` being the least
power of two that is not below the lag, and only to the nearest such occurrence. That loses nothing: a run
repeats its period, q, at least four times, and within it the nearest earlier occurrence of any q or more
words is exactly q back, since a nearer one would give the run a smaller period. By the same argument only
smallest periods are found, each run once and in full. There are at most as many cells as words for each
width, and in ordinary text hardly any.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from velograph.llm.common import slices, texts_of

MIN_LENGTH = 6
# Fixed: the reasoning above needs four periods.
_PERIODS = 4

RUN_TYPE = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False
)
_ARROW_RUNS = pa.list_(
    pa.field("element", pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]), False)
)


def sparse_cells(names: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells that may belong to a run, in the order of their words: word, lag, width.

    ``names`` are numbers of words that differ between documents; ``ends`` and ``sizes`` give for each
    word where its document ends and how many words it has.
    """
    place = np.arange(len(names))
    slot = np.empty(len(names), dtype=np.int64)
    words, lags, widths, width = [], [], [], 1
    while len(place):
        order = np.argsort(names, kind="stable")
        again = np.flatnonzero(names[order[1:]] == names[order[:-1]])
        later, earlier = order[again + 1], order[again]
        lag = place[later] - place[earlier]
        near = (lag <= width) & (2 * lag > width)
        words.append(place[later[near]])
        lags.append(lag[near])
        widths.append(np.full(near.sum(), width))
        # Twice as many words occur again only where both halves do, in a document with room for a run.
        opens = np.ones(len(order), dtype=np.int64)
        opens[again + 1] = 0
        repeated = np.zeros(len(order), dtype=bool)
        repeated[later] = repeated[earlier] = True
        slot.fill(-1)
        number = np.empty(len(order), dtype=np.int64)
        number[order] = np.cumsum(opens)
        slot[place[repeated]] = number[repeated]
        room = (place + 2 * width <= ends[place]) & (sizes[place] >= _PERIODS * (width + 1))
        first = place[repeated & room]
        second = slot[first + width]
        place = first[second >= 0]
        names = slot[place] * (len(order) + 1) + second[second >= 0]
        width *= 2
    if not words:
        return (np.empty(0, dtype=np.int64),) * 3
    words, lags, widths = map(np.concatenate, (words, lags, widths))
    order = np.argsort(words, kind="stable")
    return words[order], lags[order], widths[order]


def online_runs(
    words: np.ndarray, lags: np.ndarray, widths: np.ndarray, min_length: int = MIN_LENGTH
) -> Iterator[tuple[int, int, int]]:
    """Start, length and period of each run, as soon as its diagonal ends."""
    # Active lags: first word of the match, match length, width. A lag has one width only.
    active: dict[int, list[int]] = {}
    now = -1

    def ended(lag: int) -> Iterator[tuple[int, int, int]]:
        first, matched, width = active.pop(lag)
        length = lag + matched + width - 1
        if length >= max(min_length, _PERIODS * lag):
            yield first - lag, length, lag

    for word, lag, width in zip(words.tolist(), lags.tolist(), widths.tolist(), strict=True):
        if word != now:
            now = word
            for other in [k for k, (first, matched, _) in active.items() if first + matched < word]:
                yield from ended(other)
        if lag in active:
            active[lag][1] += 1
        else:
            active[lag] = [word, 1, width]
    for lag in list(active):
        yield from ended(lag)


def runs_of(documents: list[list[bytes]], min_length: int = MIN_LENGTH) -> list[list[tuple[int, int, int]]]:
    """The runs of each document, given as words: start, length and period, by start, then period."""
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    numbers: dict[bytes, int] = {}
    names = np.fromiter((numbers.setdefault(w, len(numbers)) for w in chain.from_iterable(documents)), dtype=np.int64)
    owner = np.repeat(np.arange(len(documents)), sizes)
    ends = np.cumsum(sizes)
    found: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    cells = sparse_cells(names + owner * len(numbers), ends[owner], sizes[owner])
    for start, length, period in online_runs(*cells, min_length):
        k = int(owner[start])
        found[k].append((start - int(ends[k] - sizes[k]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by spaces, without those that a run holds after its first period."""
    if runs:
        depth = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            depth[start + period] += 1
            depth[start + length] -= 1
        words = [words[k] for k in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]
    return b" ".join(words)


def find_periodic_runs(
    documents: DataFrame,
    *,
    text: str = "text",
    min_length: int = MIN_LENGTH,
    runs: str = "runs",
    collapsed_text: str = "collapsed_text",
) -> DataFrame:
    """``documents`` with an array ``runs`` of (start, length, period) and the text without repeats.

    Words are what stands between ASCII white space. A run is a stretch of at least ``min_length`` words
    and four smallest periods that no neighbouring word extends; starts count words from 0, runs are in
    the order of start and period. The second column keeps a run's first period only.

    One pass over the rows, each on its own: equal rows get equal results, other columns pass through,
    input columns called like the results are replaced. A null or empty text, or one of white space,
    has no runs and an empty collapsed text. A long text is one row and is taken whole, in memory in
    proportion to its words.
    """
    source = documents.drop(runs, collapsed_text)
    names = source.columns
    added = [T.StructField(runs, RUN_TYPE, False), T.StructField(collapsed_text, T.StringType(), False)]
    schema = T.StructType([*source.schema.fields, *added])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, text) for b in batches):
            # bytes.split cuts at exactly the six ASCII white space characters.
            words = [t.split() for t in texts_of(batch, text)]
            found = runs_of(words, min_length)
            kept = [collapsed(w, r).decode() for w, r in zip(words, found, strict=True)]
            found = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found]
            columns = [*batch.columns, pa.array(found, type=_ARROW_RUNS), pa.array(kept, type=pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, runs, collapsed_text])

    return source.mapInArrow(work, schema)
