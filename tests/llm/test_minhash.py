import random
import re

import numpy as np
import pytest

from velograph.llm import minhash
from velograph.llm.common import Workspace, connected_components
from velograph.llm.minhash import near_duplicates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def plain_components(texts, percent=85):
    sets = [plain_set(t) for t in texts]
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [find(k) for k in range(len(texts))], [len(s) for s in sets]


def corpus():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]

    def text(n):
        return [rng.choice(words) for _ in range(n)]

    texts = []
    for size in (30, 60, 200, 1500):
        base = text(size)
        for changes in (0, 0, 1, 2, 3, 5, 8, 13):
            near = list(base)
            for _ in range(changes):
                near[rng.randrange(size)] = rng.choice(words)
            texts.append(" ".join(near))
    # A chain: each is near the one before, the ends are far apart.
    link = text(120)
    for _ in range(12):
        texts.append(" ".join(link))
        link = link[4:] + text(4)
    same = " ".join(text(40))
    texts += [same, same.upper(), same.replace(" ", "\t\n"), "A b", "a  B", "a b c d", "", None, " \t", "x y"]
    rng.shuffle(texts)
    return texts


def test_components_match_a_plain_search(spark):
    texts = corpus()
    rows = [(k, t, "x", 1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, bands STRING, n_shingles INT").repartition(4)
    components, sizes = plain_components(texts)
    found = near_duplicates(docs).collect()
    assert len(found) == len(texts)
    for row in found:
        k = row["doc_id"]
        assert (row["n_shingles"], row["component_id"]) == (sizes[k], components[k]), texts[k]
        assert row["kept"] == (components[k] == k)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    rows = [(None, "a b c d e f"), (None, None), (4, "a b c d e f"), (4, "a b c d e f"), (7, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect() if r["doc_id"])
    assert found == [(4, 2, 4, True), (4, 2, 4, True), (7, 2, 4, False)]
    assert near_duplicates(docs.where("doc_id IS NULL")).where("kept AND component_id IS NULL").count() == 2
    assert near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("share", [0.95, 0.85, 0.7])
def test_sketches_estimate_similarity(share):
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(60):
        both = rng.integers(0, 1 << 62, int(600 * share), dtype=np.uint64)
        left, right = (rng.integers(0, 1 << 62, int(300 * (1 - share)), dtype=np.uint64) for _ in range(2))
        sets = [np.unique(np.concatenate([both, left])), np.unique(np.concatenate([both, right]))]
        bits = minhash.odd_sketches(minhash.min_samples(sets))
        errors.append(minhash.sketch_similarity(int(np.bitwise_count(bits[0] ^ bits[1]).sum())) - share)
        whole = minhash.whole_sketches(sets)
        differing = len(sets[0]) + len(sets[1]) - 2 * len(both)
        assert np.bitwise_count(whole[0].view(np.uint64) ^ whole[1].view(np.uint64)).sum() <= differing
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.08


def test_components_of_a_star_and_a_path(spark):
    star = [(k, 0) for k in range(1, 200)]
    path = [(k, k + 1) for k in range(1000, 1040)]
    edges = spark.createDataFrame([*star, *path, (5, 5), (2, 1)], "u BIGINT, v BIGINT")
    found = {r["id"]: r["component"] for r in connected_components(edges, Workspace(spark)).collect()}
    assert found == {**{k: 0 for k in range(1, 200)}, **{k: 1000 for k in range(1001, 1041)}}
    assert connected_components(edges.limit(0), Workspace(spark)).count() == 0


def templated(count, shared=140, own=30):
    """Documents of one template, at similarity 0.67 from each other."""
    template = " ".join(f"t{k}" for k in range(shared))
    return [template + " " + " ".join(f"d{k}x{j}" for j in range(own)) for k in range(count)]


def test_documents_of_one_template_make_few_candidates(spark, monkeypatch):
    seen = []
    search = minhash._candidates_across

    def counted(*args):
        pairs, groups = search(*args)
        seen.append((args[0].count(), groups.selectExpr("coalesce(sum(n * n), 0)").first()[0], pairs.count()))
        return pairs, groups

    monkeypatch.setattr(minhash, "_candidates_across", counted)
    for count in (1000, 2000, 4000):
        docs = spark.createDataFrame(list(enumerate(templated(count))), "doc_id BIGINT, text STRING")
        assert near_duplicates(docs).where("kept").count() == count
    members, joined, _ = zip(*seen, strict=True)
    assert all(m > 0.9 * n for m, n in zip(members, (1000, 2000, 4000), strict=True))
    assert all(j <= 2 * m for j, m in zip(joined, members, strict=True))


@pytest.mark.parametrize("crowd", [(0, 3), (2, 1024), (32, 1024)])
def test_links_within_a_template_are_found(spark, monkeypatch, crowd):
    """Some documents of a template are near each other, few of them their bucket's first."""
    monkeypatch.setattr(minhash, "CROWD", crowd[0])
    monkeypatch.setattr(minhash, "CROWD_BLOCK", crowd[1])
    texts = templated(40)
    texts += [t.replace("d%dx7 " % k, "changed ").replace("t3 ", "t3 t3 ") for k, t in enumerate(texts) if k % 3 == 0]
    texts += [t + " tail" for t in texts[:10]]
    components, _ = plain_components(texts)
    assert 40 <= len(set(components)) < len(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()} == dict(enumerate(components))


def test_an_id_with_several_texts_is_compared_with_each(spark):
    one, two = (" ".join(f"{name}{k}" for k in range(80)) for name in "pq")
    rows = [(5, one), (5, two), (3, one + " more"), (4, two + " more"), (9, "z y x")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    found = sorted((r["doc_id"], r["component_id"]) for r in near_duplicates(docs).collect())
    assert found == [(3, 3), (4, 4), (5, 3), (5, 4), (9, 9)]
