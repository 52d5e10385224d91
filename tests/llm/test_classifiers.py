import random

import numpy as np
import pytest

from velograph.llm import quality, toxicity
from velograph.llm.training import best_threshold, shifted

DOCS = "doc_id BIGINT, text STRING, lang STRING, score STRING"


def documents(kind):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(800)]
    rows, labels = [], []
    for k in range(2400):
        marked = k % 3 == 0
        own = [rng.choice(words) for _ in range(rng.randint(8, 80))]
        if kind == "quality" and not marked:
            own = [w + rng.choice(["***", "!!", "###"]) for w in own]
        if kind == "toxic" and marked:
            own[rng.randrange(len(own))] = rng.choice(["vilest", "rotten", "badmouth" + rng.choice(words)])
        rows.append((k, " ".join(own), rng.choice(["en", "de"]), "s"))
        labels.append((k, int(marked)))
    return rows, labels


@pytest.mark.parametrize(("method", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_documents_are_judged_right(spark, method, label):
    rows, labels = documents(label)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    known = spark.createDataFrame(labels[:1800], f"doc_id BIGINT, {label} INT")
    model = method.train(docs, known)
    found = method.score(docs, model, result="score").collect()
    assert len(found) == 2400 and {0, 1} >= {int(0 <= r["score"] <= 1) for r in found}
    right = [(r["score"] >= method.CUT) == bool(labels[r["doc_id"]][1]) for r in found if r["doc_id"] >= 1800]
    assert np.mean(right) >= 0.97
    # The score depends on the text alone.
    other = docs.selectExpr("doc_id + 5000 AS doc_id", "text", "'xx' AS lang", "score")
    again = {r["doc_id"] - 5000: r["score"] for r in method.score(other, model, result="score").collect()}
    assert again == {r["doc_id"]: r["score"] for r in found}


@pytest.mark.parametrize("method", [quality, toxicity])
def test_odd_inputs(spark, method):
    rows, labels = documents("quality")
    odd = [(None, None, None, ""), (1, "", "en", ""), (1, "", "en", ""), (2, "\0 \n", "en", ""), (3, "wort " * 100_000, "de", "")]
    docs = spark.createDataFrame(rows + odd, DOCS)
    table = spark.createDataFrame([*labels, (None, 1), (7, None), (5000, 1)], "doc_id BIGINT, y INT")
    model = method.train(docs, table, "y")
    scores = [r["score"] for r in method.score(docs, model, result="score").collect()]
    assert len(scores) == len(rows) + len(odd) and all(0 <= s <= 1 for s in scores)
    assert method.score(docs.limit(0), model).count() == 0
    untrained = method.train(docs, table.limit(0), "y")
    assert {round(r["score"], 9) for r in method.score(docs.limit(5), untrained, result="score").collect()} == {method.CUT}


def test_thresholds():
    logits, ones = np.array([-3.0, -2.0, 1.0, 4.0]), np.array([0, 0, 1, 1])
    assert best_threshold(logits, ones, clean=0) == -0.5
    assert best_threshold(logits, np.ones(4, dtype=int), clean=0) == 0.0
    assert shifted(np.array([1.9, 2.0, 2.1]), 2.0, 0.7).round(3).tolist() == [0.679, 0.7, 0.721]


def test_quality_scores_are_a_plain_forward_pass():
    """The weights of a text's buckets, one feature at a time, averaged."""
    rng = np.random.default_rng(1)
    model = quality.SubwordModel(rng.standard_normal(1 << quality.BUCKET_BITS).astype(np.float32), 0.3, 0.1)
    texts = [b"Some words, some WORDS", b"", b"x", "é 漢字 text".encode(), b"word " * 300]
    with np.errstate(over="ignore"):
        for text, logit in zip(texts, model.logits(texts), strict=True):
            buckets, owner = quality.features([text])
            total = sum(float(model.weights[b]) for b in buckets)
            assert (owner == 0).all()
            assert logit == pytest.approx(total / max(len(buckets), 1) + model.bias)
    # Together or alone, a text has the same features.
    alone = [sorted(quality.features([t])[0].tolist()) for t in texts]
    buckets, owner = quality.features(texts)
    assert [sorted(buckets[owner == k].tolist()) for k in range(len(texts))] == alone


def test_toxicity_scores_are_a_plain_forward_pass():
    """Every window of every width, one word at a time, then the largest response of each filter."""
    rng = np.random.default_rng(2)
    texts = [b"one two three four five", b"", b"none of these", b"two", b"five " * 30 + b"three one", b"two none none none two"]
    with np.errstate(over="ignore"):
        known, _ = toxicity.word_keys([b"one two three four five"])
    buckets = np.unique(known[known >= 0])
    shape = [(len(buckets) + 1, w, toxicity.FILTERS) for w in toxicity.WIDTHS]
    taps = [rng.standard_normal(s).astype(np.float32) for s in shape]
    for tap in taps:
        tap[-1] = 0
    model = toxicity.ConvolutionModel(
        buckets, taps, [rng.standard_normal(toxicity.FILTERS).astype(np.float32) for _ in taps],
        rng.standard_normal(len(taps) * toxicity.FILTERS).astype(np.float32), 0.2,
        np.zeros((len(buckets) + 1, 1), dtype=np.float32), np.zeros(1),
    )
    row_of = {int(b): k for k, b in enumerate(buckets)}
    logits, _ = model.judge(texts)
    for text, logit in zip(texts, logits, strict=True):
        with np.errstate(over="ignore"):
            keys, _ = toxicity.word_keys([text])
        rows = [[row_of.get(int(b), len(buckets)) for b in word] for word in keys]
        pooled = []
        for w, width in enumerate(toxicity.WIDTHS):
            best = []
            for s in range(len(rows)):
                words = rows[s : s + width]
                if any(r != len(buckets) for word in words for r in word):
                    best.append(sum(taps[w][r, k] for k, word in enumerate(words) for r in word) + model.filter_bias[w])
            if rows:
                pooled.append(np.max(best, axis=0) if best else model.filter_bias[w])
            else:
                pooled.append(np.zeros(toxicity.FILTERS))
        assert logit == pytest.approx(float(np.maximum(np.concatenate(pooled), 0) @ model.output) + model.bias, abs=1e-4)
