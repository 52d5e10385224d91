import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from velograph.llm.suffixes import common_prefixes, remove_repeats, repeat_columns, repeated_starts, suffix_array


def plain_spans(texts, length):
    texts = [t.encode() for t in texts]
    times = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    result = []
    for text in texts:
        removed = np.zeros(len(text), dtype=bool)
        for k in range(len(text) - length + 1):
            if times[text[k : k + length]] > 1:
                removed[k : k + length] = True
        result.append(removed)
    return result


def test_suffix_array_and_common_prefixes():
    rng = random.Random(4)
    for size in (1, 2, 9, 300):
        text = bytes(rng.choice(b"ab") for _ in range(size))
        order = suffix_array(np.frombuffer(text, dtype=np.uint8), size)
        assert order.tolist() == sorted(range(size), key=lambda k: text[k:])
        shared = common_prefixes(np.frombuffer(text, dtype=np.uint8), order)
        for (a, b), n in zip(zip(order, order[1:]), shared[1:], strict=False):
            assert text[a : a + n] == text[b : b + n] and text[a + n : a + n + 1] != text[b + n : b + n + 1]


def test_repeated_starts_match_a_plain_count():
    rng = random.Random(5)
    for _ in range(10):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(3, 60))) for _ in range(25)] + [b"abc" * 20]
        times = Counter(p[k : k + 12] for p in parts for k in range(len(p) - 11))
        stretch, offset, again, first = repeated_starts(parts, 12)
        assert len(stretch) == sum(times.values()) and first.sum() == len(times)
        for s, o, a in zip(stretch, offset, again, strict=True):
            assert (times[parts[s][o : o + 12]] > 1) == a


def corpus():
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    common = text(12)
    copy = text(30)
    texts = [text(20) + " " + common + " " + text(15) for _ in range(30)]
    return [*texts, "ab" * 60, copy, copy, copy, "", "x", None, text(10) + "ä" * 50, "é" * 3 + common]


@pytest.mark.parametrize("shard_stretches", [1000, 5])
def test_removed_bytes_match_a_plain_search(spark, shard_stretches):
    texts = corpus()
    rows = [(k if k % 7 else None, t, k, "r") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id INT, text STRING, key INT, repeats STRING").repartition(3)
    found = remove_repeats(docs, length=40, gram=16, shard_stretches=shard_stretches)
    assert found.columns == ["doc_id", "text", "key", "repeats"]
    wanted = plain_spans([t or "" for t in texts], 40)
    rows = repeat_columns(found).collect()
    assert len(rows) == len(texts)
    for row in rows:
        removed = wanted[row["key"]]
        body = (texts[row["key"]] or "").encode()
        kept = bytes(b for b, r in zip(body, removed, strict=True) if not r)
        assert row["n_bytes"] == len(body) and row["n_removed"] == removed.sum()
        assert row["n_spans"] == (np.diff(np.r_[0, removed.astype(int)]) == 1).sum()
        assert row["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id INT, text STRING")
    assert remove_repeats(docs).count() == 0
