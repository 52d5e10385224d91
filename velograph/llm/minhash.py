"""Near-duplicate documents by MinHash bands, checked with odd sketches and then on full sets.

Documents with equal shingle sets become one class first. A class has MinHash samples; groups of
samples make band keys, and the samples folded into a parity bitmap make its odd sketch: the bits in
which two sketches differ tell how many samples differ, precisely where similarity is high. A set of
few shingles is its own sample and is folded whole; two such sketches never differ in more bits than
the sets do in shingles, so that bound drops no pair that is similar enough. Classes that share a band
key are candidates; the sketches drop those that are clearly apart, and the full shingle sets decide
about the rest.

No bucket is expanded into all its pairs. Each member is first compared with one of the bucket, which
joins almost every group of copies. Members of buckets that still hold different components are
looked at again by their rarest shingles: two sets as similar as asked for share one of the few rarest
of each, so only sets of different components that do are candidates. What many documents of one template
share is frequent and brings none of them together. A crowd that shares a rare shingle is compared
block against block, on sketches, and only plausible pairs leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velograph.llm.common import (
    Workspace,
    connected_components,
    joined,
    lower_ascii,
    mix,
    slices,
    texts_of,
    word_hashes,
    word_spans,
)

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 85
BANDS = 24
BAND_SAMPLES = 4
SKETCH_WORDS = 8
# Pairs whose sketches put them below this similarity are not compared in full. Of pairs at the
# threshold the samples of one in about 10 to the 11th look so far apart.
SKETCH_FLOOR = 0.60
# Sets of at most so many shingles are folded whole, into so many 64-bit words.
WHOLE_SHINGLES = 1024
WHOLE_WORDS = 16

# Shingles are counted in so many slots, by which they are ordered from rare to frequent.
SLOT_BITS = 20
# Sets with a common rare shingle: up to so many are joined, more are compared in blocks of that size.
CROWD = 32
CROWD_BLOCK = 1024
# Of a set's rare shingles that crowds share, the first ones by number: they tell where a pair met before.
FIRST_TOKENS = 16

_SAMPLES = BANDS * BAND_SAMPLES
_LOWER = lower_ascii()
# Words are runs of anything but ASCII white space.
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_SEPARATOR = 0x20

_seeds = np.random.default_rng(20240229)
_FACTORS = _seeds.integers(0, 1 << 31, _SAMPLES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MASKS = _seeds.integers(0, 1 << 32, _SAMPLES, dtype=np.uint32)
_PLACES = mix(_seeds.integers(0, 1 << 62, SHINGLE_WORDS, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[bytes], shingle: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The distinct shingles of each text, hashed to 64 bits, in order."""
    with np.errstate(over="ignore"):
        buffer, begins = joined(texts, _SEPARATOR)
        lowered = _LOWER[buffer]
        starts, ends = word_spans(lowered, _IS_WORD)
        words = word_hashes(lowered, starts, ends)
        bounds = np.searchsorted(starts, begins)
        factors = np.resize(_PLACES, shingle)
        length = max(len(words) - shingle + 1, 0)
        hashes = np.zeros(length, dtype=np.uint64)
        for k in range(shingle):
            hashes = (hashes + words[k : k + length]) * factors[k]
        hashes = mix(hashes)
        sets = []
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if last - first >= shingle:
                sets.append(np.unique(hashes[first : last - shingle + 1]))
            elif last > first:
                whole = np.uint64(last - first)
                for word in words[first:last]:
                    whole = mix(np.atleast_1d(whole * factors[0] + word))[0]
                sets.append(np.array([whole], dtype=np.uint64))
            else:
                sets.append(np.empty(0, dtype=np.uint64))
    return sets


def min_samples(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash samples of sets that are not empty, one row each."""
    low = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    opens = np.cumsum([0, *(len(s) for s in sets[:-1])])
    samples = np.empty((len(sets), _SAMPLES), dtype=np.uint32)
    for k in range(_SAMPLES):
        samples[:, k] = np.minimum.reduceat((low ^ _MASKS[k]) * _FACTORS[k], opens)
    return samples


def odd_sketches(samples: np.ndarray, words: int = SKETCH_WORDS) -> np.ndarray:
    """Parity bitmaps, as 64-bit words: each sample toggles one bit of its row."""
    with np.errstate(over="ignore"):
        bits = mix(samples.astype(np.uint64) + (np.arange(samples.shape[1], dtype=np.uint64) << np.uint64(32)))
    bits = (bits >> np.uint64(20)) % np.uint64(64 * words)
    sketch = np.zeros((len(samples), words), dtype=np.uint64)
    row = np.repeat(np.arange(len(samples)), samples.shape[1])
    bits = bits.ravel()
    np.bitwise_xor.at(sketch, (row, (bits >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bits & np.uint64(63)))
    return sketch


def whole_sketches(sets: list[np.ndarray]) -> list[np.ndarray | None]:
    """Parity bitmaps of all shingles of each set; none for sets of too many."""
    out: list[np.ndarray | None] = []
    bits = 64 * WHOLE_WORDS
    for at in range(0, len(sets), 1000):
        few = [s if len(s) <= WHOLE_SHINGLES else s[:0] for s in sets[at : at + 1000]]
        row = np.repeat(np.arange(len(few)), [len(s) for s in few])
        place = (np.concatenate(few) % np.uint64(bits)).astype(np.int64) + row * bits
        odd = (np.bincount(place, minlength=len(few) * bits) & 1).astype(np.uint8)
        words = np.packbits(odd, bitorder="little").view(np.int64).reshape(len(few), WHOLE_WORDS)
        out += [w if len(s) else None for w, s in zip(words, few, strict=True)]
    return out


def sketch_similarity(differing_bits: float, samples: int = _SAMPLES, words: int = SKETCH_WORDS) -> float:
    """The similarity that so many differing bits speak for."""
    size = 64 * words
    share = min(2 * differing_bits / size, 1 - 1 / size)
    return 1 + size / (4 * samples) * float(np.log1p(-share))


def _most_differing_bits(floor: float) -> int:
    return max(b for b in range(64 * SKETCH_WORDS // 2) if sketch_similarity(b) >= floor)


def _signatures(documents: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_key, n_shingles, two sums that tell sets apart, band keys and sketches (null for empty sets)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            sets = shingle_sets(texts_of(batch, "text"), shingle)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(sizes)
            keys, sketches, wholes = ([None] * len(sets) for _ in range(3))
            sums = np.zeros((len(sets), 2), dtype=np.uint64)
            if len(full):
                samples = min_samples([sets[k] for k in full])
                with np.errstate(over="ignore"):
                    bands = samples.reshape(len(full), BANDS, BAND_SAMPLES).astype(np.uint64)
                    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bands.shape[:2])
                    for k in range(BAND_SAMPLES):
                        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k])
                    for k in full:
                        sums[k] = sets[k].sum(dtype=np.uint64), mix(sets[k]).sum(dtype=np.uint64)
                made = key.view(np.int64), odd_sketches(samples).view(np.int64), whole_sketches([sets[k] for k in full])
                for k, own, bits, whole in zip(full, *made, strict=True):
                    keys[k], sketches[k], wholes[k] = own, bits, whole
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes),
                    pa.array(sums[:, 0].view(np.int64)),
                    pa.array(sums[:, 1].view(np.int64)),
                    pa.array(keys, type=longs),
                    pa.array(sketches, type=longs),
                    pa.array(wholes, type=longs),
                ],
                names=["doc_id", "text_key", "n_shingles", "sum1", "sum2", "bands", "sketch", "whole"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInArrow(
        work,
        f"doc_id {kind}, text_key BIGINT, n_shingles BIGINT, sum1 BIGINT, sum2 BIGINT, bands ARRAY<BIGINT>, sketch ARRAY<BIGINT>, "
        "whole ARRAY<BIGINT>",
    )


def _plausible(percent: int) -> Column:
    """Whether sizes and sketches of u and v allow the similarity asked for."""
    sizes = F.least("u_size", "v_size") * 100 >= F.greatest("u_size", "v_size") * percent
    near = _differing("sketch", SKETCH_WORDS) <= _most_differing_bits(SKETCH_FLOOR)
    # Of a union of n shingles at most (100 - percent) n / 100 lie in one set only.
    differ = _differing("whole", WHOLE_WORDS) * (100 + percent) <= (F.col("u_size") + F.col("v_size")) * (100 - percent)
    return sizes & near & F.coalesce(differ, F.lit(True))


def _differing(sketch: str, words: int) -> Column:
    u, v = F.col(f"u_{sketch}"), F.col(f"v_{sketch}")
    return reduce(Column.__add__, [F.bit_count(u[k].bitwiseXOR(v[k])) for k in range(words)])


def _side(classes: DataFrame, name: str) -> DataFrame:
    renamed = {"rep": name, "n_shingles": f"{name}_size", "sketch": f"{name}_sketch", "whole": f"{name}_whole"}
    return classes.select(*(F.col(c).alias(n) for c, n in renamed.items()))


def _linked(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are similar enough."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_set = None, None
        for batch in batches:
            kept = []
            u_text, v_text = batch.column("u_text"), batch.column("v_text")
            for k, v in enumerate(batch.column("v").to_pylist()):
                if known_set is None or v != known:
                    known, (known_set,) = v, shingle_sets([v_text[k].as_py().encode()], shingle)
                (own,) = shingle_sets([u_text[k].as_py().encode()], shingle)
                common = len(np.intersect1d(own, known_set, assume_unique=True))
                if 100 * common >= percent * (len(own) + len(known_set) - common):
                    kept.append(k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(kept, type=pa.int64())) for c in ("u", "v")], names=["u", "v"]
            )

    with_u = pairs.join(texts.select(F.col("rep").alias("u"), F.col("text").alias("u_text")), "u")
    both = with_u.join(texts.select(F.col("rep").alias("v"), F.col("text").alias("v_text")), "v")
    return both.select("u", "v", "u_text", "v_text").mapInArrow(work, "u BIGINT, v BIGINT")


def _slot_ranks(texts: DataFrame, shingle: int) -> np.ndarray:
    """How frequent the shingles of each slot are among ``texts``, as a rough logarithm of one byte.

    One entry per slot comes to the driver and goes out with the tasks, whatever the number of texts.
    """
    shift = np.uint64(64 - SLOT_BITS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            sets = shingle_sets(texts_of(batch, "text"), shingle)
            slots, counts = np.unique(np.concatenate(sets) >> shift, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int64)), pa.array(counts)], names=["slot", "n"])

    counted = texts.select("text").mapInArrow(work, "slot BIGINT, n BIGINT").groupBy("slot").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    ranks = np.zeros(1 << SLOT_BITS, dtype=np.uint8)
    ranks[found.column("slot").to_numpy()] = np.minimum(8 * np.log2(found.column("n").to_numpy()), 255)
    return ranks


def _rare_shingles(texts: DataFrame, ranks: np.ndarray, shingle: int, percent: int) -> DataFrame:
    """The rarest shingles of each text, as many as must hold a common one with any similar set: token, rep."""
    shift = np.uint64(64 - SLOT_BITS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(slices(b, "text") for b in batches):
            tokens = []
            for hashes in shingle_sets(texts_of(batch, "text"), shingle):
                # Sets are in the order of hashes, so a stable sort by rank is one order for all.
                order = np.argsort(ranks[hashes >> shift], kind="stable")
                tokens.append(hashes[order[: len(hashes) - -(-percent * len(hashes) // 100) + 1]])
            reps = np.repeat(batch.column("rep").to_numpy(), [len(t) for t in tokens])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(reps)], names=["token", "rep"]
            )

    return texts.select("rep", "text").mapInArrow(work, "token BIGINT, rep BIGINT")


def _first_tokens(lists: pd.Series, token: int) -> np.ndarray:
    """The lists as rows of one width; what is missing is filled up with ``token``."""
    out = np.full((len(lists), FIRST_TOKENS), token, dtype=np.int64)
    for k, own in enumerate(lists):
        out[k, : len(own)] = own
    return out


def _crowd_pairs(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The plausible pairs between the sets of two blocks, across components."""
    left = rows[rows["side"] == 0]
    right = left if rows["a"].iloc[0] == rows["b"].iloc[0] else rows[rows["side"] == 1]
    sizes = [x["n_shingles"].to_numpy(dtype=np.int64) for x in (left, right)]
    least, most = np.minimum.outer(*sizes), np.maximum.outer(*sizes)
    fit = (100 * least >= percent * most) & np.not_equal.outer(left["component"].to_numpy(), right["component"].to_numpy())
    u, v = np.nonzero(fit)
    for name, words in (("sketch", SKETCH_WORDS), ("whole", WHOLE_WORDS)):
        empty = np.zeros(words, dtype=np.int64)
        known = [x[name].notna().to_numpy() for x in (left, right)]
        bits = [np.array([empty if w is None else w for w in x[name]], dtype=np.int64).view(np.uint64) for x in (left, right)]
        kept = []
        for at in range(0, len(u), 1 << 16):
            a, b = u[at : at + (1 << 16)], v[at : at + (1 << 16)]
            differing = np.bitwise_count(bits[0][a] ^ bits[1][b]).sum(axis=1, dtype=np.int64)
            if name == "sketch":
                near = differing <= _most_differing_bits(SKETCH_FLOOR)
            else:
                near = differing * (100 + percent) <= (sizes[0][a] + sizes[1][b]) * (100 - percent)
            kept.append(near | ~(known[0][a] & known[1][b]))
        chosen = np.concatenate(kept) if kept else np.empty(0, dtype=bool)
        u, v = u[chosen], v[chosen]
    # A pair that shares an earlier token is found there as well: it is left to that crowd.
    token = rows["token"].iloc[0]
    earlier = [_first_tokens(x["first"], token) for x in (left, right)]
    again = np.zeros(len(u), dtype=bool)
    for at in range(0, len(u), 1 << 12):
        a, b = (e[k[at : at + (1 << 12)]] for e, k in zip(earlier, (u, v), strict=True))
        again[at : at + (1 << 12)] = ((a[:, :, None] == b[:, None, :]) & (a < token)[:, :, None]).any(axis=(1, 2))
    u, v = left["rep"].to_numpy()[u[~again]], right["rep"].to_numpy()[v[~again]]
    return pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)}).drop_duplicates()


def _candidates_across(
    divided: DataFrame, texts: DataFrame, classes: DataFrame, shingle: int, percent: int, work: Workspace
) -> tuple[DataFrame, DataFrame]:
    """Plausible pairs (u, v) of different components among ``divided`` (rep, component).

    Also the groups of sets that share a rare shingle, as token, n: joined rows are at most n * n of
    each group of no more than ``CROWD``.
    """
    # Read twice rather than written: the texts are large, the table of members is not.
    own = texts.join(divided.select("rep"), "rep", "left_semi")
    ranks = _slot_ranks(own, shingle)
    shared = work.keep(_rare_shingles(own, ranks, shingle, percent).join(divided, "rep"))
    groups = work.keep(
        shared.groupBy("token")
        .agg(F.count("*").alias("n"), F.min("component").alias("least"), F.max("component").alias("most"))
        .where("least <> most")
        .select("token", "n")
    )
    met = shared.join(groups, "token").join(classes.select("rep", "n_shingles"), "rep")
    few = met.where(F.col("n") <= CROWD)
    sides = [few.select("token", *(F.col(c).alias(f"{x}_{c}") for c in ("rep", "component", "n_shingles"))) for x in "uv"]
    size = F.least("u_n_shingles", "v_n_shingles") * 100 >= F.greatest("u_n_shingles", "v_n_shingles") * percent
    joined_pairs = sides[0].join(sides[1], "token").where("u_rep < v_rep AND u_component <> v_component").where(size)
    joined_pairs = joined_pairs.select(F.col("u_rep").alias("u"), F.col("v_rep").alias("v")).distinct()
    plausible = joined_pairs.join(_side(classes, "u"), "u").join(_side(classes, "v"), "v").where(_plausible(percent))

    first = F.slice(F.array_sort(F.collect_list("token")), 1, FIRST_TOKENS).alias("first")
    in_crowd = met.where(F.col("n") > CROWD).drop("n_shingles")
    facts = met.join(in_crowd.select("rep").distinct(), "rep", "left_semi").groupBy("rep").agg(first)
    facts = facts.join(classes.select("rep", "n_shingles", "sketch", "whole"), "rep")
    crowd = in_crowd.withColumn("blocks", F.ceil(F.col("n") / CROWD_BLOCK)).join(facts, "rep")
    crowd = crowd.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("theirs")
    dealt = crowd.select("token", "rep", "component", "n_shingles", "sketch", "whole", "first", "mine", each)
    dealt = dealt.withColumn("side", F.when(F.col("mine") <= F.col("theirs"), 0).otherwise(1))
    dealt = dealt.withColumn("a", F.least("mine", "theirs")).withColumn("b", F.greatest("mine", "theirs"))
    in_crowds = dealt.drop("mine", "theirs").groupBy("token", "a", "b").applyInPandas(
        lambda rows: _crowd_pairs(rows, percent), "u BIGINT, v BIGINT"
    )
    pairs = work.keep(plausible.select("u", "v").unionByName(in_crowds).distinct())
    work.drop(shared)
    return pairs, groups


def near_duplicates(
    documents: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    percent: int = SIMILARITY_PERCENT,
    work: Workspace | None = None,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable by links), kept.

    A null or empty text, or one without words, has no shingles and is linked with nothing. Rows that
    repeat an id are compared each with its own text, and rows that repeat both give equal rows. A row
    without id is linked with nothing and has no component. A text of any length is one row and is
    hashed whole. Other columns are not read. Without rows there are none.

    The result is a written table of ``work``, whose caller may drop it; all others go before the end.
    """
    work = work or Workspace(documents.sparkSession)
    source = documents.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_key")
    )
    signed = work.keep(_signatures(source, shingle_words))
    same_set = ["n_shingles", "sum1", "sum2"]
    # A class is known by a number of its own, and by one row of it: its least id, with that row's text.
    classes = work.keep(
        signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*same_set)
        .agg(F.min(F.struct("doc_id", "text_key")).alias("one"), *(F.first(c).alias(c) for c in ("bands", "sketch", "whole")))
        .withColumn("rep", F.monotonically_increasing_id())
    )
    members = classes.select("rep", F.explode("bands").alias("key"))
    buckets = work.keep(
        members.groupBy("key").agg(F.min("rep").alias("center"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    crowded = work.keep(members.join(buckets, "key"))
    starred = crowded.where("rep <> center").select(F.col("rep").alias("u"), F.col("center").alias("v")).distinct()
    starred = starred.join(_side(classes, "u"), "u").join(_side(classes, "v"), "v").where(_plausible(percent))
    candidates = work.keep(starred.select("u", "v"))
    involved = classes.select("rep", "one.*").join(crowded.select("rep").distinct(), "rep")
    texts = source.join(involved, ["doc_id", "text_key"]).groupBy("rep").agg(F.first("text").alias("text"))
    texts = work.keep(texts)
    links = work.keep(_linked(candidates, texts, shingle_words, percent))
    work.drop(candidates)
    stars = connected_components(links, work)
    work.drop(links)

    grouped = crowded.join(stars, crowded["rep"] == stars["id"], "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = grouped.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"))
    mixed = work.keep(mixed.where("least <> most"))
    divided = work.keep(grouped.join(mixed, "key", "left_semi").select("rep", "component").distinct())
    across, groups = _candidates_across(divided, texts, classes, shingle_words, percent, work)
    more = work.keep(_linked(across, texts, shingle_words, percent))
    work.drop(crowded, buckets, mixed, divided, across, groups, texts)
    final = connected_components(stars.select(F.col("id").alias("u"), F.col("component").alias("v")).union(more), work)
    work.drop(stars, more)

    placed = classes.join(final, classes["rep"] == final["id"], "left").select(
        *same_set, F.coalesce("component", "rep").alias("component"), F.col("one.doc_id").alias("least")
    )
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    placed = work.keep(placed.join(least, "component").select(*same_set, "component_id"))
    work.drop(final, classes)
    found = signed.select("doc_id", *same_set).join(placed, same_set, "left")
    found = found.withColumn("component_id", F.expr("CASE WHEN doc_id IS NOT NULL THEN coalesce(component_id, doc_id) END"))
    kept = F.expr("doc_id <=> component_id").alias("kept")
    found = work.keep(found.select("doc_id", "n_shingles", "component_id", kept))
    work.drop(signed, placed)
    return found
