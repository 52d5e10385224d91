import random
import re

import numpy as np
import pytest

from velograph.llm.decontamination import Patterns, _Texts, contamination_columns, find_benchmark_text, words_of

NO_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return NO_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(text, items, window=13):
    words, hit, names = plain_words(text), set(), set()
    for name, item in items:
        own = plain_words(item)
        size = min(window, len(own))
        parts = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if size else set()
        for k in range(len(words) - size + 1):
            if tuple(words[k : k + size]) in parts:
                hit.update(range(k, k + size))
                names.add(name)
    return len(words), len(hit), sorted(names)


LONG = " ".join(f"w{k}" for k in range(30))
ITEMS = [("1", LONG), ("2", "Short One"), ("10", "einzig"), ("3", "short one"), ("4", "..."), ("5", "a b a b a b"), ("9\\n\n9", LONG[4:]), ("11", "w3 w4 w5")]
TEXTS = [
    "x " + LONG.upper() + " y",
    "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 wrong w12",
    "a short, one! short one",
    "Einzig" * 2 + " einzig",
    "a b a b a b a b a",
    "",
    None,
    "äöü " * 200 + " ".join(LONG.split()[5:18]) + " z" * 300,
    "short",
    "one",
]


@pytest.mark.parametrize(("block_bytes", "held_bytes"), [(1 << 20, 1 << 28), (20, 1 << 28), (20, 0)])
def test_counts_match_a_plain_search(spark, block_bytes, held_bytes):
    docs = spark.createDataFrame([(k, t, "c") for k, t in enumerate(TEXTS)], "doc_id INT, text STRING, contamination STRING")
    items = spark.createDataFrame([*ITEMS, (None, "w1"), ("6", None)], "item_id STRING, text STRING").repartition(1)
    found = find_benchmark_text(docs, items, block_bytes=block_bytes, held_bytes=held_bytes)
    for row in contamination_columns(found).collect():
        n_words, n_hit, names = expected(TEXTS[row["doc_id"]], ITEMS)
        assert (row["n_words"], row["n_hit"], row["n_items"]) == (n_words, n_hit, len(names)), row
        assert row["contamination"]["items"] == names
        assert row["contaminated"] == (n_hit > 0 and 20 * n_hit >= n_words)


def test_spans_stay_within_their_document(spark):
    docs = spark.createDataFrame([(1, "short"), (2, "one short one"), (2, "one short one")], "doc_id INT, text STRING")
    items = spark.createDataFrame([(1, "short one")], "item_id INT, text STRING")
    found = find_benchmark_text(docs.coalesce(1), items).collect()
    assert [[tuple(s) for s in r["contamination"]["spans"]] for r in found] == [[], [(1, 3)], [(1, 3)]]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id INT, text STRING")
    items = spark.createDataFrame([], "item_id INT, text STRING")
    assert contamination_columns(find_benchmark_text(docs, items)).first()["contaminated"] is False
    assert find_benchmark_text(docs.limit(0), items).count() == 0


def test_very_long_text_and_many_items(spark):
    rng = random.Random(4)
    words = [f"v{k}" for k in range(5000)]
    items = [(str(k), " ".join(rng.choices(words, k=rng.randrange(5, 60)))) for k in range(120)]
    long = rng.choices(words, k=150_000)
    for k, (_, item) in enumerate(items[:50]):
        long[2500 * k : 2500 * k] = item.split()[:20]
    docs = spark.createDataFrame([(1, " ".join(long)), (2, "v1 v2"), (3, items[60][1])], "doc_id INT, text STRING")
    table = spark.createDataFrame(items, "item_id STRING, text STRING").repartition(3)
    found = find_benchmark_text(docs, table, block_bytes=5000).collect()
    for row in found:
        n_words, n_hit, names = expected(row["text"], items)
        result = row["contamination"]
        assert (result["n_words"], sum(s["end"] - s["start"] for s in result["spans"]), result["items"]) == (n_words, n_hit, names)
        assert len(names) == {1: 50, 2: 0, 3: 1}[row["doc_id"]]


def test_shifts_stay_long_for_a_large_benchmark():
    rng = np.random.default_rng(5)
    words = [b"w%d" % k for k in range(20_000)]
    items = [(str(k), b" ".join(words[j] for j in rng.integers(0, 20_000, 1200))) for k in range(1000)]
    assert sum(len(t) for _, t in items) > 6 << 20
    stored = Patterns.build(items)
    patterns = Patterns(stored)
    (group,) = patterns.groups
    assert sum(v.nbytes for v in stored.values()) < 16 * sum(len(t) for _, t in items)
    probes = rng.integers(0, len(group.shift), 100_000)
    assert group.shift[probes].mean() > 13 / 2
    text = b" ".join([words[k] for k in rng.integers(0, 20_000, 3000)] + items[7][1].split()[100:140])
    spans, names = patterns.scan(_Texts([text]))
    assert names == [{"7"}] and spans[0].tolist() == [[3000, 3040]]


def test_words():
    assert words_of("Ab-c 1é_Z".encode()) == [b"ab", b"c", "1é".encode(), b"z"]
