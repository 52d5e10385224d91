"""Loops that are cut off and go on, paths on request, cost limits."""

import pytest

from tests.test_graph import paths_by_hand, random_edges, ranks_by_hand
from velograph import operators as op
from velograph.layout.rounds import Rounds
from velograph.operators import paths


class Cut(Exception):
    pass


@pytest.fixture
def make_edges(spark):
    return lambda data: spark.createDataFrame(data, "source INT, target INT, weight INT")


def cut_off(monkeypatch, at):
    """The driver is lost in round ``at``, after the round's tables were written and before it is listed."""
    add = Rounds.add

    def stop(self, state):
        if state["round"] == at:
            raise Cut
        add(self, state)

    monkeypatch.setattr(Rounds, "add", stop)


@pytest.mark.parametrize(("at", "rows_per_task", "cost_step"), [(1, 10**6, None), (3, 4, None), (17, 10**6, None), (5, 4, 3)])
def test_paths_go_on_after_the_last_finished_round(make_edges, rows, tmp_path, monkeypatch, at, rows_per_task, cost_step):
    chain = [(1000 + k, 1001 + k, 1) for k in range(at + 3)]
    data = random_edges(40, 160, 3, hub_share=0.35) + [(0, 1000, 1), *chain]
    edges, folder = make_edges(data), str(tmp_path / "state")
    ask = {"rows_per_task": rows_per_task, "state_folder": folder, "cost_step": cost_step}
    with monkeypatch.context() as patched:
        cut_off(patched, at)
        with pytest.raises(Cut):
            op.shortest_paths(edges, 0, **ask)
    relaxed = []
    relax = paths._relax
    monkeypatch.setattr(paths, "_relax", lambda *a: relaxed.append(a[1]["round"]) or relax(*a))
    got = rows(op.shortest_paths(edges, 0, **ask))
    assert got == paths_by_hand(data, 0, {s for s, _, _ in data})
    assert relaxed[0] == at - 1
    # Asked again, the finished search is only read.
    relaxed.clear()
    assert rows(op.shortest_paths(edges, 0, **ask)) == got and relaxed == []


@pytest.mark.parametrize("rows_per_task", [5, 10**6])
def test_ranks_go_on_after_the_last_written_iteration(make_edges, rows, tmp_path, monkeypatch, rows_per_task):
    data = random_edges(40, 500, 2, hub_share=0.35) + [(n, (n * 7) % 40, 1) for n in range(40)]
    edges, folder = make_edges(data), str(tmp_path / "state")
    ask = {"rows_per_task": rows_per_task, "checkpoint_interval": 2, "state_folder": folder}
    with monkeypatch.context() as patched:
        cut_off(patched, 4)
        with pytest.raises(Cut):
            op.pagerank(edges, 0.2, 7, **ask)
    assert Rounds(edges.sparkSession, folder).last()["round"] == 2
    assert dict(rows(op.pagerank(edges, 0.2, 7, **ask))) == pytest.approx(ranks_by_hand(data, 0.2, 7))
    assert Rounds(edges.sparkSession, folder).last()["round"] == 6
    with pytest.raises(ValueError, match="past 3"):
        op.pagerank(edges, 0.2, 3, **ask)


@pytest.mark.parametrize("cost_step", [1, 4, 1000])
@pytest.mark.parametrize("seed", [1, 6])
def test_cost_limits_change_no_path(make_edges, rows, cost_step, seed):
    data = random_edges(40, 160, seed, hub_share=0.3) + [(0, 5, 0), (5, 0, 0), (5, 6, 0)]
    got = rows(op.shortest_paths(make_edges(data), 0, cost_step=cost_step))
    assert got == paths_by_hand(data, 0, {s for s, _, _ in data})


def test_rounds_write_what_they_improve(spark, make_edges, rows, tmp_path):
    """Many leaves are known after the first round; the later ones write the few nodes that they add."""
    data = [(0, k, 1) for k in range(1, 2001)] + [(k, k + 1, 1) for k in range(3000, 3005)] + [(2000, 3000, 1)]
    op.shortest_paths(make_edges(data), 0, state_folder=str(tmp_path / "s"))
    written = spark.read.parquet(str(tmp_path / "s" / "known0")).groupBy("round").count()
    assert dict(rows(written)) == {0: 1, 1: 2000} | dict.fromkeys(range(2, 8), 1)


def test_paths_to_asked_nodes_of_a_long_chain(spark, make_edges, rows):
    data = [(k, k + 1, 1) for k in range(40)] + [(0, 100 + k, 2) for k in range(5)]
    tree = op.shortest_path_tree(make_edges(data), 0, include_sinks=True)
    asked = spark.createDataFrame([(40,), (7,), (0,), (103,), (7,), (None,), (555,)], "id INT")
    expected = {n: (c, p) for n, c, p in paths_by_hand(data, 0, {n for s, t, _ in data for n in (s, t)})}
    got = {n: (c, p) for n, c, p in rows(op.paths_to(tree, asked))}
    assert got == {k: expected.get(k, (-1, "")) for k in (40, 7, 0, 103, 555)}
    assert rows(op.paths_to(tree, asked.limit(0))) == []


def test_the_tree_has_the_paths_of_the_listing(make_edges, rows):
    data = random_edges(50, 150, 12)
    tree = op.shortest_path_tree(make_edges(data), 0, include_sinks=True)
    assert tree.columns == ["id", "cost", "hops", "previous"]
    listed = rows(op.shortest_paths(make_edges(data), 0, include_sinks=True))
    assert sorted(rows(op.paths_to(tree, tree))) == sorted(listed)
    for node, cost, hops, previous in rows(tree):
        path = {n: p for n, _, p in listed}[node].split("-")
        assert (hops is None) == (cost < 0) and (cost < 0 or len(path) == hops + 1)
        assert previous == (int(path[-2]) if cost >= 0 and hops else None)


def test_pairs_are_made_once_without_a_cache(spark, make_edges, rows, tmp_path, monkeypatch):
    """The pairs of nodes are neither cached nor made again for the counts, and their files go."""
    from velograph.layout import lineage

    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.persist", None)
    paths_written, write = [], lineage._written
    monkeypatch.setattr(lineage, "_written", lambda df: paths_written.append(write(df)) or paths_written[-1])
    made = spark.sparkContext.accumulator(0)
    data = random_edges(40, 160, 3, hub_share=0.3)
    edges = spark.createDataFrame(spark.sparkContext.parallelize(data, 2).map(lambda r: made.add(1) or r), "source INT, target INT, weight INT")
    got = rows(op.shortest_path_tree(edges, 0, rows_per_task=8))
    assert {n: c for n, c, _, _ in got} == {n: c for n, c, _ in paths_by_hand(data, 0, {s for s, _, _ in data})}
    assert made.value == len(data)
    path = paths_written[0][1]
    assert len(paths_written) == 1 and not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
