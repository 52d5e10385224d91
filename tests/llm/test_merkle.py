from hashlib import sha256

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from velograph.llm import merkle
from velograph.llm.common import Workspace
from velograph.llm.merkle import Path, Subtree, fold_leaves, table_manifest, tree_levels


def H(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def levels_over(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[k : k + 2]) for k in range(0, len(last), 2)])
    return levels


def leaf_of(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute(rows, tampered):
    """doc_id, source, lang, n_chars, text: leaf, subroot, root, proof, folded root per row, by the definition."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = levels_over([leaf_of(r) for r in groups[g]])
    top = levels_over([trees[g][-1][0] for g in order])
    found = []
    for place, g in enumerate(order):
        for at, row in enumerate(groups[g]):
            node, proof, where = leaf_of(tampered(row)), "", at
            for tree, where in ((trees[g], at), (top, place)):
                for level in tree[:-1]:
                    run = level[where - where % 2 :][: 2]
                    others = [n for k, n in enumerate(run) if k != where % 2]
                    proof += "".join(others)
                    run[where % 2] = node
                    node, where = H(*run), where // 2
            root = top[-1][0]
            found.append((row[0], trees[g][0][at], trees[g][-1][0], root, H(proof), node, node == root))
    return found


def rows_of(count, groups):
    return [(k * 7 % 1000 if k % 11 else None, f"s{k}", groups[k % len(groups)], None if k % 5 == 0 else k, "é" * (k % 4)) for k in range(count)]


SCHEMA = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING, `group` STRING, position INT"


def tampered(row):
    return (*row[:3], row[3] + 1 if row[3] is not None and row[3] % 3 == 0 else row[3], row[4])


@pytest.mark.parametrize(("count", "groups", "levels"), [
    (1, ["a"], 10), (2, ["a", "b"], 10), (3, ["a", "b", None], 10), (37, ["a"], 10),
    (200, ["b", None, "ä", "a", "Z"], 10), (300, ["a", "a", "a", "b", ""], 2), (150, [f"g{k}" for k in range(40)], 1),
])
def test_manifest_agrees_with_the_definition(spark, count, groups, levels):
    rows = rows_of(count, groups) + rows_of(2, groups)
    documents = spark.createDataFrame([(*r, "other", k) for k, r in enumerate(rows)], SCHEMA)
    changed = F.coalesce(F.col("n_chars") % 3 == 0, F.lit(False))
    present = {"n_chars": F.col("n_chars") + 1}
    manifest = table_manifest(documents, Workspace(spark), present=present, changed=changed, levels=levels)
    assert sorted(map(tuple, fold_leaves(manifest).collect()), key=repr) == sorted(brute(rows, tampered), key=repr)


def test_an_unchanged_table_verifies_and_an_empty_one_has_no_root(spark):
    documents = spark.createDataFrame([(*r, "x", 0) for r in rows_of(20, ["a", None])], SCHEMA)
    found = fold_leaves(table_manifest(documents, Workspace(spark))).collect()
    assert len(found) == 20 and all(r["verified"] for r in found)
    empty = table_manifest(documents.limit(0), Workspace(spark))
    assert empty.root is None and fold_leaves(empty).count() == 0


def test_a_very_long_text_and_null_against_empty(spark):
    rows = [(1, "s", "a", 5, "long " * 1_000_000), (2, None, "a", 0, None), (3, "", "a", 0, "")]
    documents = spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)
    found = sorted(map(tuple, fold_leaves(table_manifest(documents, Workspace(spark))).collect()))
    assert found == brute(rows, lambda row: row)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.integers(2, 4), st.data())
def test_folding_resumes_states(count, arity, data):
    nodes = [b"%064d" % k for k in range(count)]
    levels = tree_levels(count, arity)
    tree, at = Subtree(nodes, levels, arity), data.draw(st.integers(0, count - 1))
    changed = [b"x" * 64 if k == at else n for k, n in enumerate(nodes)]
    assert tree.fold(at, b"x" * 64) == Subtree(changed, levels, arity).root
    assert tree.fold(at, nodes[at]) == tree.root
    # The path of siblings alone gives the same, and the tree's own states are not used up.
    assert Path(tree.siblings(at)).fold(b"x" * 64) == tree.fold(at, b"x" * 64)


class Counting:
    """A hash that counts the bytes it is given after a copy."""

    seen = 0

    def __init__(self, data=b""):
        self.inner = sha256(data)

    def copy(self):
        other = Counting()
        other.inner = self.inner.copy()
        return other

    def update(self, data):
        Counting.seen += len(data)
        self.inner.update(data)

    def hexdigest(self):
        return self.inner.hexdigest()


def test_folding_hashes_the_replacement_and_right_siblings_only(monkeypatch):
    monkeypatch.setattr(merkle, "sha256", Counting)
    tree = Subtree([b"%064d" % k for k in range(8)], 3)
    for at, right in ((0, 3), (7, 0), (2, 2), (5, 1)):
        Counting.seen = 0
        tree.fold(at, b"y" * 64)
        assert Counting.seen == 64 * (3 + right)
