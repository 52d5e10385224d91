"""Removal of repeated byte strings with suffix arrays, shard by shard.

Strings of a fixed length are judged; each belongs to the smallest of the hashed grams within it, its
anchor, which depends on the string's bytes alone. Equal strings have equal anchors, so only stretches
around grams that occur again can hold repeats, and all occurrences of a gram's stretches go to one
shard: nothing is lost, and no shard has to be compared with all others. Equal stretches are counted
before the texts are fetched and are compared once.

A shard's stretches make one text. Its suffix array is refined as by Larsson and Sadakane, doubling
the sorted depth and touching only groups that are still tied; Kasai's bound gives the common
prefixes, of which those of at least the length mark repeats. A gram with very many stretches is cut
over several shards. Each of these writes its strings' digests as sorted runs, and the runs are
merged by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from velograph.llm.common import Workspace, mix, slices, texts_of

LENGTH = 200
GRAM = 32
# Stretches in one shard, and the most of one gram.
SHARD_STRETCHES = 1000

# Bytes whose anchors are looked for together: far below two to the place bits.
_PIECE = 1 << 20
_GRAM_FACTOR = 0x9E3779B97F4A7C15
_PLACE_BITS = 24


# Suffix arrays


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes of ``text``, sorted by at least their first ``depth`` bytes."""
    size = len(text)
    padded = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    head = np.zeros(size, dtype=np.uint64)
    for k in range(8):
        head = (head << np.uint64(8)) | padded[k : k + size]
    return refined_order(head, 8, depth)[0]


def refined_order(head: np.ndarray, done: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and which of them open a group of suffixes that are tied.

    ``head`` orders suffixes by their first ``done`` symbols. Each round doubles that depth, sorting
    tied suffixes by the ranks of what follows, until it is at least ``depth`` or no ties are left.
    """
    size = len(head)
    order = np.argsort(head, kind="stable")
    opens = np.r_[True, head[order][1:] != head[order][:-1]][:size]
    # A group's rank is the place of its first suffix; the end of the text ranks before all.
    rank = np.full(size + 1, -1, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, np.arange(size), 0))
    while done < depth:
        tied = np.flatnonzero(~opens | ~np.r_[opens[1:], True])
        if not len(tied):
            break
        own = order[tied]
        first = rank[own]
        second = rank[np.minimum(own + done, size)]
        again = np.argsort(first * (size + 1) + second + 1, kind="stable")
        own, first, second = own[again], first[again], second[again]
        order[tied] = own
        opens[tied] = np.r_[True, (first[1:] != first[:-1]) | (second[1:] != second[:-1])]
        rank[own] = np.maximum.accumulate(np.where(opens[tied], tied, 0))
        done *= 2
    return order, opens


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the prefix that each sorted suffix shares with the one before it.

    By Kasai's bound a suffix shares at least one byte less than the suffix one position earlier. It is
    exactly one less where the two have neighbouring predecessors and the bytes before those agree;
    all others are compared, eight bytes at a time, and the bound fills in the rest. This holds for an
    order that is sorted to a depth only, too.
    """
    size = len(text)
    before = np.full(size, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    follows = (before[1:] == before[:-1] + 1) & (before[:-1] >= 0) & (text[:-1] == text[before[1:] - 1])
    differs = np.r_[True, ~follows]
    at = np.flatnonzero(differs)
    shared = np.zeros(len(at), dtype=np.int64)
    padded = np.concatenate([text, np.zeros(16, dtype=np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (size + 8, 8), (1, 1))
    running = np.flatnonzero(before[at] >= 0)
    while len(running):
        a, b = at[running] + shared[running], before[at[running]] + shared[running]
        same = words[np.minimum(a, size)] == words[np.minimum(b, size)]
        count = np.where(same.all(axis=1), 8, np.argmin(same, axis=1))
        room = size - np.maximum(a, b)
        shared[running] += np.minimum(count, room)
        running = running[(count == 8) & (room > 8)]
    reach = np.zeros(size, dtype=np.int64)
    filled = np.maximum.accumulate(np.where(differs, np.arange(size), 0))
    reach[at] = shared + at
    return (reach[filled] - np.arange(size))[order]


def repeated_starts(stretches: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All starts of strings of ``length`` within the stretches, sorted by string: stretch, offset,
    whether the same string starts anywhere else, and whether it is the first of its kind."""
    text = np.frombuffer(b"".join(stretches), dtype=np.uint8)
    sizes = np.array([len(s) for s in stretches])
    begins = np.cumsum(sizes) - sizes
    order = suffix_array(text, length)
    shared = common_prefixes(text, order)
    stretch = np.repeat(np.arange(len(stretches)), sizes)[order]
    offset = order - begins[stretch]
    whole = offset + length <= sizes[stretch]
    # Suffixes too short for a string may lie between equal strings: the least shared prefix counts.
    group = np.cumsum(shared < length)[whole]
    opens = np.r_[True, group[1:] != group[:-1]] if len(group) else np.empty(0, dtype=bool)
    return stretch[whole], offset[whole], ~(opens & np.r_[opens[1:], True]), opens


# Anchors


def anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of strings with the same anchor: text, first start, last start, hash of the gram."""
    found = []
    pieces, held = [], 0
    for k, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, _PIECE):
            pieces.append((k, at))
            held += min(len(text) - at, _PIECE + length)
            if held >= _PIECE:
                found.append(_anchors_of(texts, pieces, length, gram))
                pieces, held = [], 0
    if pieces:
        found.append(_anchors_of(texts, pieces, length, gram))
    if not found:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, np.empty(0, dtype=np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _anchors_of(texts: list[bytes], pieces: list[tuple[int, int]], length: int, gram: int) -> tuple[np.ndarray, ...]:
    parts = [texts[k][at : at + _PIECE + length - 1] for k, at in pieces]
    buffer = np.frombuffer(b"".join(parts), dtype=np.uint8)
    with np.errstate(over="ignore"):
        hashes, size, factor = buffer.astype(np.uint64) + np.uint64(1), 1, np.uint64(_GRAM_FACTOR)
        while size < gram:
            hashes = hashes[:-size] * factor + hashes[size:]
            size, factor = 2 * size, factor * factor
        hashes = mix(hashes)
    place = np.arange(len(hashes), dtype=np.uint64)
    # The place breaks ties between equal grams of a string: the first one is the anchor.
    least = (hashes & ~np.uint64((1 << _PLACE_BITS) - 1)) | place
    size, width = 1, length - gram + 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    sizes = np.array([len(p) for p in parts])
    begins = np.cumsum(sizes) - sizes
    counts = sizes - length + 1
    number = np.repeat(np.arange(len(parts)), counts)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + begins[number]
    anchor = (least[starts] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    opens = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (number[1:] != number[:-1])])
    closes = np.r_[opens[1:], len(starts)] - 1
    piece = number[opens]
    base = np.array([at for _, at in pieces])[piece] - begins[piece]
    owner = np.array([k for k, _ in pieces])[piece]
    return owner, starts[opens] + base, starts[closes] + base, hashes[anchor[opens]]


def _text_key(text: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(text)).view(np.int64))


def _batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    return chain.from_iterable(slices(b, column) for b in batches)


def _gram_counts(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, "text"):
            *_, grams = anchors(texts_of(batch, "text"), length, gram)
            found, count = np.unique(grams, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count)], names=["gram", "n"])

    return texts.select("text").mapInArrow(work, "gram BIGINT, n BIGINT")


_STRETCH = "key BIGINT, n_bytes BIGINT, gram BIGINT, d1 BIGINT, d2 BIGINT, size BIGINT, n BIGINT, spans ARRAY<BIGINT>"


def _stretches(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Per text and distinct stretch in it: how often it occurs there, and the spans it covers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches, "text"):
            contents = texts_of(batch, "text")
            owner, first, last, grams = anchors(contents, length, gram)
            keys = [_text_key(t) for t in contents]
            digests = np.empty((len(owner), 2), dtype=np.uint64)
            for k, (o, a, b) in enumerate(zip(owner.tolist(), first.tolist(), last.tolist(), strict=True)):
                value = xxhash.xxh3_128_intdigest(contents[o][a : b + length])
                digests[k] = value >> 64, value & 0xFFFFFFFFFFFFFFFF
            order = np.lexsort((first, digests[:, 1], digests[:, 0], owner))
            owner, first, last, grams, digests = owner[order], first[order], last[order], grams[order], digests[order]
            opens = np.ones(len(owner), dtype=bool)
            opens[1:] = (owner[1:] != owner[:-1]) | (digests[1:] != digests[:-1]).any(axis=1)
            # Overlapping copies of a stretch in one text become one span.
            cut = opens.copy()
            cut[1:] |= first[1:] > last[:-1] + length
            span_at = np.flatnonzero(cut)
            span_end = last[np.r_[span_at[1:], len(cut)] - 1] + length if len(cut) else last
            at = np.flatnonzero(opens)
            bounds = np.searchsorted(span_at, np.r_[at, len(cut)])
            flat = np.stack([first[span_at], span_end], axis=1).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([keys[o] for o in owner[at].tolist()], type=pa.int64()),
                    pa.array([len(contents[o]) for o in owner[at].tolist()], type=pa.int64()),
                    pa.array(grams[at].view(np.int64)),
                    pa.array(digests[at, 0].view(np.int64)),
                    pa.array(digests[at, 1].view(np.int64)),
                    pa.array((last - first)[at] + length),
                    pa.array(np.diff(np.r_[at, len(owner)])),
                    pa.ListArray.from_arrays(pa.array((2 * bounds).astype(np.int32)), pa.array(flat)),
                ],
                names=["key", "n_bytes", "gram", "d1", "d2", "size", "n", "spans"],
            )

    return texts.select("text").mapInArrow(work, _STRETCH)


def _keyed(documents: DataFrame, columns: list[str]) -> DataFrame:
    """The rows with their text compressed, and the key and size that tell texts apart."""
    schema = T.StructType([documents.schema[c] for c in columns])
    schema = schema.add("key", "long").add("n_bytes", "long").add("packed", "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in _batches(batches, "text"):
            contents = texts_of(batch, "text")
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array([_text_key(t) for t in contents], type=pa.int64()),
                    pa.array([len(t) for t in contents], type=pa.int64()),
                    pa.array([squeeze(t) for t in contents], type=pa.binary()),
                ],
                names=[*columns, "key", "n_bytes", "packed"],
            )

    return documents.mapInArrow(work, schema)


def _cut_out(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """The bytes of single stretches; each text is fetched once for all of its stretches."""
    fields = ("gram", "d1", "d2", "n", "salts", "start", "stop")
    by_text = wanted.groupBy("key", "n_bytes").agg(F.collect_list(F.struct(*fields)).alias("parts"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loosen = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in range(batch.num_rows):
                key, size, parts, packed = (batch.column(c)[row].as_py() for c in ("key", "n_bytes", "parts", "packed"))
                text = loosen(packed, max_output_size=size)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(parts), type=pa.int64()),
                        pa.array([size] * len(parts), type=pa.int64()),
                        *(pa.array([p[f] for p in parts], type=pa.int64()) for f in fields[:-1]),
                        pa.array([text[p["start"] : p["stop"]] for p in parts], type=pa.binary()),
                    ],
                    names=["key", "n_bytes", *fields[:-1], "content"],
                )

    one_each = texts.groupBy("key", "n_bytes").agg(F.first("packed").alias("packed"))
    columns = ", ".join(f"{f} BIGINT" for f in ("key", "n_bytes", *fields[:-1]))
    return by_text.join(one_each, ["key", "n_bytes"]).mapInArrow(work, f"{columns}, content BINARY")


def _merged(starts: np.ndarray, length: int) -> list[int]:
    """Sorted starts of strings as flat, merged spans."""
    cut = np.flatnonzero(np.r_[True, np.diff(starts) > length])
    ends = starts[np.r_[cut[1:], len(starts)] - 1] + length
    return np.stack([starts[cut], ends], axis=1).ravel().tolist()


_FOUND = "key BIGINT, n_bytes BIGINT, spans ARRAY<BIGINT>, gram BIGINT, bucket BIGINT, run BINARY, places BINARY"


def _judge_shard(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Spans found in one shard; for a gram that is cut over shards also its sorted runs of digests."""
    rows = rows.sort_values(["gram", "d1", "d2"]).reset_index(drop=True)
    contents = rows["content"].tolist()
    stretch, offset, again, first = repeated_starts(contents, length)
    single = rows["n"].to_numpy() == 1
    keys, sizes, starts = (rows[c].to_numpy() for c in ("key", "n_bytes", "start"))
    out = []
    hit = again & single[stretch]
    by_place = np.lexsort((offset[hit], stretch[hit]))
    owner, at = stretch[hit][by_place], (starts[stretch] + offset)[hit][by_place]
    for part in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(owner)) + 1):
        if len(part):
            k = owner[part[0]]
            out.append((keys[k], sizes[k], _merged(at[part], length), None, None, None, None))
    salts = int(rows["salts"].iloc[0])
    if salts:
        strings = np.flatnonzero(first)
        digests = np.empty((len(strings), 2), dtype="<u8")
        for k, s in enumerate(strings.tolist()):
            value = xxhash.xxh3_128_intdigest(contents[stretch[s]][offset[s] : offset[s] + length])
            digests[k] = value >> 64, value & 0xFFFFFFFFFFFFFFFF
        order = np.lexsort((digests[:, 1], digests[:, 0]))
        digests, strings = digests[order], strings[order]
        own = stretch[strings]
        # Strings that are known to repeat only help others: they carry no place.
        open_ = single[own] & ~again[strings]
        places = np.where(open_[:, None], np.stack([keys[own], sizes[own], starts[own] + offset[strings]], axis=1), -1)
        bucket = (digests[:, 0] % np.uint64(salts)).astype(np.int64)
        for b in np.unique(bucket).tolist():
            run = bucket == b
            out.append(
                (None, None, None, rows["gram"].iloc[0], b, digests[run].tobytes(), places[run].astype("<i8").tobytes())
            )
    names = ["key", "n_bytes", "spans", "gram", "bucket", "run", "places"]
    found = pd.DataFrame(out, columns=names, dtype=object)
    return found.astype({c: "Int64" for c in ("key", "n_bytes", "gram", "bucket")})


def _merge_runs(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Look each run up, by binary search, in the others; spans of strings found there."""
    runs = [np.frombuffer(r, dtype="<u8").reshape(-1, 2) for r in rows["run"]]
    places = np.concatenate([np.frombuffer(p, dtype="<i8").reshape(-1, 3) for p in rows["places"]])
    pairs = np.concatenate(runs).astype(">u8").view("V16").ravel()
    keys = np.ascontiguousarray(pairs).view("S16")
    # Bytes that end in zeros compare as shorter strings do, so equal digests stay equal.
    everything = np.sort(keys)
    times = np.searchsorted(everything, keys, "right") - np.searchsorted(everything, keys, "left")
    found = places[(times > 1) & (places[:, 1] >= 0)]
    spans = [[int(p), int(p) + length] for p in found[:, 2]]
    return pd.DataFrame({"key": found[:, 0], "n_bytes": found[:, 1], "spans": pd.Series(spans, dtype=object)})


def repeated_spans(
    texts: DataFrame, work: Workspace, *, length: int = LENGTH, gram: int = GRAM, shard_stretches: int = SHARD_STRETCHES
) -> DataFrame:
    """key, n_bytes and spans (a list of flat start and end lists) of each text with repeats."""
    repeated = work.keep(
        _gram_counts(texts, length, gram).groupBy("gram").agg(F.sum("n").alias("total")).where("total > 1").select("gram")
    )
    stretches = work.keep(_stretches(texts, length, gram).join(repeated, "gram"))
    same = ["gram", "d1", "d2"]
    kinds = work.keep(
        stretches.groupBy(*same).agg(
            F.sum("n").alias("n"),
            F.max("size").alias("size"),
            F.min(F.struct("key", "n_bytes", F.col("spans")[0].alias("start"))).alias("place"),
        )
    )
    # Stretches that occur again as a whole are repeats all over.
    whole = stretches.join(kinds.where("n > 1").select(*same), same).select("key", "n_bytes", "spans")
    spread = work.keep(kinds.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    total = spread.agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0]
    salts = F.when(F.col("kinds") > shard_stretches, F.ceil(F.col("kinds") / shard_stretches)).otherwise(0)
    wanted = kinds.join(spread, "gram").select(
        *same, "n", salts.alias("salts"), "place.*", (F.col("place.start") + F.col("size")).alias("stop")
    )
    contents = _cut_out(wanted, _keyed(texts, []))
    shards = max(1, total // shard_stretches)
    shard = F.when(F.col("salts") > 0, F.col("gram")).otherwise(F.pmod(F.xxhash64("gram"), F.lit(shards)))
    part = F.when(F.col("salts") > 0, 1 + F.pmod(F.col("d1"), F.col("salts"))).otherwise(0)
    judged = (
        contents.withColumn("shard", shard)
        .withColumn("part", part)
        .groupBy("shard", "part")
        .applyInPandas(lambda rows: _judge_shard(rows, length), _FOUND)
    )
    judged = work.keep(judged)
    merged = (
        judged.where("run IS NOT NULL")
        .select("gram", "bucket", "run", "places")
        .groupBy("gram", "bucket")
        .applyInPandas(lambda rows: _merge_runs(rows, length), "key BIGINT, n_bytes BIGINT, spans ARRAY<BIGINT>")
    )
    found = whole.unionByName(judged.where("spans IS NOT NULL").select("key", "n_bytes", "spans")).unionByName(merged)
    return work.keep(found.groupBy("key", "n_bytes").agg(F.collect_set("spans").alias("spans")))


def remove_repeats(
    documents: DataFrame,
    *,
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    shard_stretches: int = SHARD_STRETCHES,
    result: str = "repeats",
) -> DataFrame:
    """``documents`` with a struct ``result``: n_bytes, spans (merged, removed), kept (bytes), kept_text.

    A character of which a part is removed is not in ``kept_text``.

    Each byte covered by a string of ``length`` bytes that starts anywhere else is removed, judged on
    the input. A null text is empty; texts shorter than ``length`` stay as they are. Equal rows repeat
    each other. A column already called ``result`` is replaced.
    """
    work = Workspace(documents.sparkSession)
    source = documents.drop(result)
    names = source.columns
    spans = repeated_spans(
        source.select(F.col(text).alias("text")), work, length=length, gram=gram, shard_stretches=shard_stretches
    )
    others = [c for c in names if c != text]
    # The text travels compressed, under names that no input column has.
    row = F.struct(*(others or [F.lit(0).alias("none")])).alias("row")
    packed = _keyed(source.select(row, F.col(text).alias("text")), ["row"])
    joined_rows = packed.join(spans, ["key", "n_bytes"], "left")
    found_type = pa.struct(
        [
            ("n_bytes", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("kept", pa.binary()),
            ("kept_text", pa.string()),
        ]
    )
    schema = T.StructType([packed.schema["row"]]).add("text", "string").add("found", from_arrow_type(found_type))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loosen = zstandard.ZstdDecompressor().decompress
        for batch in (part for b in batches for part in _in_small_parts(b)):
            texts, found = [], []
            columns = (batch.column(c).to_pylist() for c in ("n_bytes", "packed", "spans"))
            for size, content, lists in zip(*columns, strict=True):
                body = loosen(content, max_output_size=size) if size else b""
                merged: list[list[int]] = []
                for start, end in sorted((s[k], s[k + 1]) for s in lists or () for k in range(0, len(s), 2)):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                edges = [0, *(e for span in merged for e in span), size]
                kept = b"".join(body[edges[k] : edges[k + 1]] for k in range(0, len(edges), 2))
                texts.append(body)
                found.append({"n_bytes": size, "spans": [{"start": a, "end": b} for a, b in merged]})
                found[-1] |= {"kept": kept, "kept_text": kept.decode("utf-8", "ignore")}
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(texts, type=pa.binary()).cast(pa.string()), pa.array(found, type=found_type)],
                names=["row", "text", "found"],
            )

    done = joined_rows.mapInArrow(finish, schema)
    columns = [F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in names]
    return done.select(*columns, F.col("found").alias(result))


def _in_small_parts(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def repeat_columns(found: DataFrame, result: str = "repeats") -> DataFrame:
    """The digest of each document: n_bytes, n_removed, n_spans and kept_sha256."""
    return (
        found.withColumn("n_bytes", F.col(f"{result}.n_bytes"))
        .withColumn("n_removed", F.col(f"{result}.n_bytes") - F.octet_length(f"{result}.kept"))
        .withColumn("n_spans", F.size(f"{result}.spans").cast("bigint"))
        .withColumn("kept_sha256", F.sha2(f"{result}.kept", 256))
    )

