import numpy as np
import pyarrow as pa
import pytest

from velograph.llm.vectors import _Forest, near_duplicate_vectors

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, copies STRING"


def vectors():
    rng = np.random.default_rng(6)
    rows = []
    for label in (1, 2):
        for size in (1, 1, 1, 2, 3, 40):
            center = rng.standard_normal(16)
            for _ in range(size):
                rows.append((center + rng.standard_normal(16) * 0.18 * np.linalg.norm(center) / 4).tolist())
                rows[-1] = (rows[-1], label)
    base = rng.standard_normal(16).tolist()
    rows += [(base, 1)] * 5 + [([2 * x for x in base], 1), (base, 2), (base, None)]
    rows += [([0.0] * 16, 1), ([-0.0] * 16, 1), ([float("nan")] * 16, 1), ([float("inf")] + base[1:], 1)]
    rows += [([None] + base[1:], 1), (None, 1), ([], 1), (base[:8], 1), ([1e-30] * 16, 3), ([1e30] * 16, 3)]
    return rows


def plain(rows):
    usable = [
        e is not None and len(e) > 0 and label is not None and None not in e
        and np.isfinite(np.array(e, dtype=float)).all() and np.any(np.array(e) != 0)
        for e, label in rows
    ]
    links = [set() for _ in rows]
    for a, (x, la) in enumerate(rows):
        for b, (y, lb) in enumerate(rows[:a]):
            if usable[a] and usable[b] and la == lb and len(x) == len(y):
                u, v = np.array(x, dtype=np.float32).astype(float), np.array(y, dtype=np.float32).astype(float)
                if u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= 0.98:
                    links[a].add(b)
                    links[b].add(a)
    component = list(range(len(rows)))
    changed = True
    while changed:
        best = [min([component[k], *(component[n] for n in links[k])]) for k in range(len(rows))]
        changed, component = best != component, best
    return [len(s) for s in links], component


@pytest.mark.parametrize(("block", "pair_block"), [(512, 8192), (7, 5)])
def test_links_match_all_pairs(spark, block, pair_block):
    rows = vectors()
    data = [(k, e, label, "c") for k, (e, label) in enumerate(rows)]
    table = spark.createDataFrame(data, SCHEMA).repartition(3)
    found = near_duplicate_vectors(table, window=8, block=block, pair_block=pair_block).collect()
    links, component = plain(rows)
    assert len(found) == len(rows)
    for row in found:
        k = row["vec_id"]
        assert (row["n_links"], row["component_id"]) == (links[k], component[k]), (k, rows[k])
        assert row["kept"] == (component[k] == k)


def test_recall_of_the_passes(spark):
    rng = np.random.default_rng(8)
    centers = rng.standard_normal((300, 32))
    near = centers + 0.15 * rng.standard_normal((300, 32))
    unit = [x / np.linalg.norm(x, axis=1, keepdims=True) for x in (centers, near)]
    linked = (unit[0] * unit[1]).sum(axis=1) >= 0.98
    data = [(k, row.tolist(), 1, "") for k, row in enumerate(np.concatenate([centers, near]))]
    found = near_duplicate_vectors(spark.createDataFrame(data, SCHEMA), window=8).where("n_links > 0").count()
    assert linked.sum() > 50 and found >= 0.98 * 2 * linked.sum()


def dense_label(background, count, pairs, size=64):
    """Vectors of one label around one direction, some with a partner at cosine 0.985; and their links."""
    rng = np.random.default_rng(31)
    center = np.zeros(size)
    center[0] = np.sqrt(background)
    noise = rng.standard_normal((count, size))
    noise[:, 0] = 0
    unit = center + np.sqrt(1 - background) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    for k in range(pairs):
        side = rng.standard_normal(size)
        side -= side @ unit[2 * k] * unit[2 * k]
        unit[2 * k + 1] = 0.985 * unit[2 * k] + np.sqrt(1 - 0.985**2) * side / np.linalg.norm(side)
    unit = unit.astype(np.float32)
    wide = unit.astype(np.float64)
    wide /= np.linalg.norm(wide, axis=1, keepdims=True)
    links = [np.argwhere(np.triu(wide[k : k + 500] @ wide.T >= 0.98, k + 1)) + [k, 0] for k in range(0, count, 500)]
    return unit, np.concatenate(links)


@pytest.mark.parametrize("background", [0, 0.9, 0.95])
def test_recall_in_one_label_of_many_vectors(spark, background):
    unit, links = dense_label(background, 30_000, 300)
    assert len(links) >= 299
    values = pa.ListArray.from_arrays(pa.array(range(0, unit.size + 1, unit.shape[1]), type=pa.int32()), unit.ravel())
    table = spark.createDataFrame(pa.table({"vec_id": range(len(unit)), "embedding": values, "label": [1] * len(unit)}))
    found = {r["vec_id"]: r["component_id"] for r in near_duplicate_vectors(table).where("n_links > 0").collect()}
    recall = np.mean([u in found and found.get(u) == found.get(v) for u, v in links.tolist()])
    assert recall >= 0.97
    assert set(found) <= set(links.ravel().tolist())


def test_a_forest_joins_what_the_links_join():
    rng = np.random.default_rng(3)
    for count in (1, 2, 9, 40):
        linked = np.tril(rng.random((count, count)) < 1.2 / count, -1)
        forest = _Forest(count)
        forest.add(linked, np.arange(count), np.arange(count))
        label = np.arange(count)
        while True:
            low = np.array([min([label[k], *label[linked[k] | linked[:, k]]]) for k in range(count)])
            if (low == label).all():
                break
            label = low
        assert len(forest.links) == count - len(set(label.tolist()))
        assert all(linked[u, v] or linked[v, u] for u, v in forest.links)
        assert all((forest.roots[u] == forest.roots[v]) == (label[u] == label[v]) for u in range(count) for v in range(count))


def test_null_ids_and_empty_tables(spark):
    table = spark.createDataFrame([(None, [1.0, 2.0], 1, ""), (3, [1.0, 2.0], 1, "")], SCHEMA)
    found = {r["vec_id"]: tuple(r)[1:] for r in near_duplicate_vectors(table).collect()}
    assert found == {None: (0, None, True), 3: (0, 3, True)}
    assert near_duplicate_vectors(table.limit(0)).count() == 0
