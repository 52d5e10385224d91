"""Adjacency, PageRank and shortest paths."""

import heapq
import random
from collections import Counter, defaultdict

import pytest

from velograph import operators as op

PAIRS = "1-2 1-3 1-4 2-3 2-5 2-6 3-4 3-6 3-7 4-7 5-6 6-7 6-8"
WEIGHTED_PAIRS = "1-2:3 1-3:4 2-4:2 3-4:3 4-5:1 5-6:4 3-5:5"
# Unrounded ranks of PAIRS for reset 0.15 and 3 iterations, and their listing.
RANKS = {
    6: 1.6866691747685183, 3: 1.4053299965277775, 2: 1.2046304560185184, 4: 0.9318657314814814,
    1: 0.8896932372685185, 7: 0.8658387546296296, 5: 0.6352665937499999, 8: 0.38070605555555553,
}
RANK_LISTING = [(6, 1.69), (3, 1.41), (2, 1.2), (4, 0.93), (1, 0.89), (7, 0.87), (5, 0.64), (8, 0.38)]
PATHS = [(1, 0, "1"), (2, 3, "1-2"), (3, 4, "1-3"), (4, 5, "1-2-4"), (5, 6, "1-2-4-5"),
         (6, 10, "1-2-4-5-6")]


def both_ways(text):
    edges = []
    for item in text.split():
        pair, _, weight = item.partition(":")
        a, b = map(int, pair.split("-"))
        edges += [(a, b, int(weight or 1)), (b, a, int(weight or 1))]
    return sorted(edges)


@pytest.fixture
def make_edges(spark):
    return lambda data: spark.createDataFrame(data, "source INT, target INT, weight INT")


def random_edges(n_nodes, n_edges, seed, hub_share=0.0, max_weight=9):
    """Edges with loops and parallel edges; ``hub_share`` of them leave node 0."""
    draw = random.Random(seed)
    return [(0 if draw.random() < hub_share else draw.randrange(n_nodes), draw.randrange(n_nodes),
             draw.randint(1, max_weight)) for _ in range(n_edges)]


def ranks_by_hand(edges, reset, iterations, direction="in"):
    nodes = {n for s, t, _ in edges for n in (s, t)}
    degree = Counter(s for s, _, _ in edges)
    ranks = dict.fromkeys(nodes, 1.0)
    for _ in range(iterations):
        received = defaultdict(float)
        for s, t, _ in edges:
            giver, taker = (s, t) if direction == "in" else (t, s)
            received[taker] += ranks[giver] / degree[giver]
        ranks = {n: reset + (1 - reset) * received[n] for n in nodes}
    return ranks


def paths_by_hand(edges, start, domain):
    """Cheapest path per node, by a priority queue: fewest hops, then least predecessor among equals."""
    out = defaultdict(list)
    for s, t, w in edges:
        out[s].append((t, w))
    best, queue = {}, [(0, 0, -1, start, str(start))]
    while queue:
        cost, hops, _, node, path = heapq.heappop(queue)
        if node in best:
            continue
        best[node] = (cost, path)
        for t, w in out[node]:
            if t not in best:
                heapq.heappush(queue, (cost + w, hops + 1, node, t, f"{path}-{t}"))
    return [(n, *best.get(n, (-1, ""))) for n in sorted(domain)]


# Adjacency


def test_adjacency_of_directed_edges(make_edges, rows):
    edges = make_edges([(5, 2, 1), (5, 2, 4), (5, 0, 1), (2, 9, 1)])
    got = op.build_adjacency(edges)
    assert sorted(rows(got)) == [(0, 0, 0, []), (2, 1, 0, [9]), (5, 3, 0, [0, 2, 2]), (9, 0, 0, [])]
    assert got.dtypes == [
        ("id", "int"), ("num_neighbours", "bigint"), ("block", "int"), ("neighbours", "array<int>")]
    assert rows(op.node_count(edges)) == [(4,)]
    assert sorted(rows(op.distinct_nodes(edges))) == [(0,), (2,), (5,), (9,)]
    assert sorted(rows(op.out_degree(edges))) == [(2, 1), (5, 3)]


@pytest.mark.parametrize("per_block", [1, 10, 100])
def test_adjacency_comes_in_full_sorted_blocks(make_edges, rows, per_block):
    """Hubs and parallel edges: every block but a node's last is full, and all are in order."""
    edges = random_edges(60, 600, 5, hub_share=0.4) + [(1, 2, 1)] * 450 + [(70, 71, 1)]
    expected = defaultdict(list)
    for s, t, _ in edges:
        expected[s].append(t)
        expected[t] += []
    blocks = defaultdict(dict)
    for node, degree, block, neighbours in rows(op.build_adjacency(make_edges(edges), per_block)):
        assert degree == len(expected[node]) and block not in blocks[node]
        blocks[node][block] = neighbours
    assert set(blocks) == set(expected)
    for node, own in blocks.items():
        wanted = sorted(expected[node])
        cut = [wanted[k : k + per_block] for k in range(0, len(wanted), per_block)] or [[]]
        assert [own[k] for k in sorted(own)] == cut and sorted(own) == list(range(len(cut)))


def test_incomplete_edges_are_refused_or_left_out_by_all(make_edges, rows):
    edges = make_edges([(1, 2, 3), (None, 4, 1), (5, None, 1), (2, 1, None)])
    whole = [
        lambda e, **o: op.distinct_nodes(e, **o),
        lambda e, **o: op.out_degree(e, **o),
        lambda e, **o: op.build_adjacency(e, **o),
        lambda e, **o: op.pagerank(e, **o),
    ]
    for operator in whole:
        with pytest.raises(Exception, match="edge without source or target"):
            operator(edges).collect()
        assert {r[0] for r in rows(operator(edges, drop_incomplete=True))} == {1, 2}
    with pytest.raises(Exception, match="edge without source or target or weight"):
        op.shortest_paths(edges, 1).collect()
    found = rows(op.shortest_paths(edges, 1, include_sinks=True, drop_incomplete=True))
    assert found == [(1, 0, "1"), (2, 3, "1-2")]


# PageRank


@pytest.mark.parametrize("direction", ["in", "out"])
def test_pagerank_golden(make_edges, rows, direction):
    ranks = op.pagerank(make_edges(both_ways(PAIRS)), 0.15, 3, direction)
    assert {n: pytest.approx(r, abs=1e-9) for n, r in rows(ranks)} == RANKS
    assert rows(op.rank_listing(ranks)) == RANK_LISTING


@pytest.mark.parametrize("rows_per_task", [3, 10**6])
@pytest.mark.parametrize("direction", ["in", "out"])
def test_pagerank_of_a_skewed_multigraph(make_edges, rows, direction, rows_per_task):
    edges = random_edges(40, 500, 2, hub_share=0.35) + [(n, (n * 7) % 40, 1) for n in range(40)]
    got = dict(rows(op.pagerank(make_edges(edges), 0.2, 4, direction, rows_per_task, checkpoint_interval=2)))
    assert got == pytest.approx(ranks_by_hand(edges, 0.2, 4, direction))


def test_pagerank_with_sinks_and_odd_ids(make_edges, rows):
    edges = [(0, 100, 1), (100, -5, 1), (7, 0, 1), (7, 100, 1), (7, 7, 1)]
    got = dict(rows(op.pagerank(make_edges(edges))))
    assert got == pytest.approx(ranks_by_hand(edges, 0.15, 3))
    assert set(got) == {0, 100, -5, 7}


def test_pagerank_without_iterations(make_edges, rows):
    assert sorted(rows(op.pagerank(make_edges([(1, 2, 1)]), max_iterations=0))) == [(1, 1.0), (2, 1.0)]


def test_pagerank_out_refuses_sinks(make_edges):
    with pytest.raises(ValueError, match="no outgoing edges"):
        op.pagerank(make_edges([(1, 2, 1)]), direction="out")


def test_pagerank_refuses_other_directions(make_edges):
    with pytest.raises(ValueError, match="direction"):
        op.pagerank(make_edges([(1, 2, 1)]), direction="both")


def test_rank_listing_breaks_ties_by_descending_id(spark, rows):
    ranks = spark.createDataFrame([(1, 0.571), (2, 0.574), (3, 0.9), (10, 0.57)], "id INT, pagerank DOUBLE")
    assert rows(op.rank_listing(ranks)) == [(3, 0.9), (10, 0.57), (2, 0.57), (1, 0.57)]


def test_rank_listing_rounds_by_the_stored_value(make_edges, rows):
    """0.15 + 0.85 / 2 is stored a little below 0.575."""
    edges = make_edges([(1, 2, 1), (1, 3, 1)])
    ranks = op.rank_listing(op.pagerank(edges, 0.15, 1))
    assert rows(ranks) == [(3, round(0.15 + 0.85 * 0.5, 2)), (2, round(0.15 + 0.85 * 0.5, 2)), (1, 0.15)]
    assert round(0.15 + 0.85 * 0.5, 2) == 0.57


# Shortest paths


def test_paths_golden(make_edges, rows):
    paths = op.shortest_paths(make_edges(both_ways(WEIGHTED_PAIRS)), 1)
    assert rows(paths) == PATHS
    assert paths.dtypes == [("id", "int"), ("cost", "bigint"), ("path", "string")]


@pytest.mark.parametrize("seed,rows_per_task", [(1, 10**6), (2, 4), (3, 10**6), (4, 1)])
def test_paths_of_random_graphs(make_edges, rows, seed, rows_per_task):
    edges = random_edges(40, 160, seed, hub_share=0.35)
    sources = {s for s, _, _ in edges}
    got = rows(op.shortest_paths(make_edges(edges), 0, rows_per_task=rows_per_task))
    assert got == paths_by_hand(edges, 0, sources)
    cost = {n: c for n, c, _ in got}
    assert all(cost[t] <= cost[s] + w for s, t, w in edges if t in sources and cost[s] >= 0)


def test_paths_with_sinks(make_edges, rows):
    edges = random_edges(60, 90, 8)
    nodes = {n for s, t, _ in edges for n in (s, t)}
    start = edges[0][0]
    got = rows(op.shortest_paths(make_edges(edges), start, include_sinks=True))
    assert got == paths_by_hand(edges, start, nodes)


def test_paths_name_no_sink_by_default(make_edges, rows):
    """Even if the cheapest edge of the start leads to one."""
    edges = make_edges([(1, 9, 1), (1, 2, 5), (2, 1, 5)])
    assert rows(op.shortest_paths(edges, 1)) == [(1, 0, "1"), (2, 5, "1-2")]


def test_paths_from_an_unknown_start(make_edges, rows):
    assert rows(op.shortest_paths(make_edges([(1, 2, 1), (2, 1, 1)]), 77)) == [(1, -1, ""), (2, -1, "")]


def test_paths_unreachable_loops_and_parallel_edges(make_edges, rows):
    edges = make_edges([(1, 1, 0), (1, 2, 9), (1, 2, 4), (2, 2, 1), (3, 1, 1), (4, 4, 1), (2, 5, 0), (5, 1, 1)])
    assert rows(op.shortest_paths(edges, 1)) == [
        (1, 0, "1"), (2, 4, "1-2"), (3, -1, ""), (4, -1, ""), (5, 4, "1-2-5")]


def test_equal_costs_take_the_fewest_hops_and_the_least_predecessor(make_edges, rows):
    edges = make_edges([(1, 10, 1), (1, 9, 1), (10, 5, 1), (9, 5, 1), (5, 1, 1)])
    assert dict((n, p) for n, _, p in rows(op.shortest_paths(edges, 1)))[5] == "1-9-5"


def test_zero_weight_cycle_ends(make_edges, rows):
    edges = make_edges([(1, 2, 0), (2, 3, 0), (3, 2, 0), (3, 1, 0)])
    assert rows(op.shortest_paths(edges, 1)) == [(1, 0, "1"), (2, 0, "1-2"), (3, 0, "1-2-3")]


def test_costs_past_int(make_edges, rows):
    big = 2**31 - 1
    edges = make_edges([(1, 2, big), (2, 3, big), (3, 1, big)])
    assert rows(op.shortest_paths(edges, 1))[2] == (3, 2 * big, "1-2-3")


def test_negative_weights_and_no_edges_are_refused(make_edges):
    with pytest.raises(ValueError, match="negative"):
        op.shortest_paths(make_edges([(1, 2, 3), (2, 1, -1)]), 1)
    with pytest.raises(ValueError, match="no edges"):
        op.shortest_paths(make_edges([]), 1)


# Single steps


def test_steps_lead_to_the_same_paths(spark, make_edges, rows):
    """Settling one node at a time ends with the answer of the whole search."""
    from velograph.layout import cut_lineage

    edges = make_edges(both_ways(WEIGHTED_PAIRS)).persist()
    paths, frontier = op.initial_paths(edges, 1), op.initial_frontier(edges, 1)
    steps = 0
    while not frontier.isEmpty():
        paths, frontier = (cut_lineage(df) for df in op.advance(edges, paths, frontier))
        steps += 1
    assert steps == 5
    assert rows(paths.orderBy("id")) == PATHS


def test_single_steps(make_edges, rows):
    edges = make_edges([(1, 2, 4), (1, 2, 9), (1, 3, 4), (2, 3, 1), (2, 1, 1), (3, 2, 1), (7, 3, 1)])
    paths, frontier = op.initial_paths(edges, 1), op.initial_frontier(edges, 1)
    assert sorted(rows(paths)) == [(1, 0, "1"), (2, -1, ""), (3, -1, ""), (7, -1, "")]
    best = op.best_frontier_edge(paths, frontier)
    assert rows(best) == [(1, 2, 4, "1")]
    assert best.columns == ["candidate_source", "candidate_target", "candidate_cost", "candidate_path"]
    settled = op.settle(paths, best)
    assert sorted(rows(settled)) == [(1, 0, "1"), (2, 4, "1-2"), (3, -1, ""), (7, -1, "")]
    assert rows(op.drop_used_edge(frontier, best)) == [(1, 3, 4)]
    assert sorted(rows(op.edges_leaving(edges, best))) == [(2, 1, 1), (2, 3, 1)]
    assert sorted(rows(op.edges_to_unvisited(edges, settled))) == [(1, 3, 4), (2, 3, 1), (7, 3, 1)]
    assert rows(op.best_frontier_edge(paths, frontier.filter("false"))) == []


def test_steps_ignore_loops(make_edges, rows):
    edges = make_edges([(1, 1, 1), (1, 2, 5), (2, 2, 1), (2, 3, 1)])
    paths, frontier = op.initial_paths(edges, 1), op.initial_frontier(edges, 1)
    assert rows(frontier) == [(1, 2, 5)]
    paths, frontier = op.advance(edges, paths, frontier)
    assert sorted(rows(paths)) == [(1, 0, "1"), (2, 5, "1-2")]
    assert rows(op.edges_leaving(edges, op.best_frontier_edge(op.initial_paths(edges, 1), op.initial_frontier(edges, 1)))) == [(2, 3, 1)]


def test_used_edge_is_dropped_where_nothing_else_would_drop_it(make_edges, rows):
    """The target stays open here, so only the used edge itself can be missing."""
    frontier = make_edges([(1, 2, 5), (1, 2, 7), (1, 3, 9), (4, 2, 1)])
    best = frontier.sparkSession.createDataFrame(
        [(1, 2, 5, "1")], "candidate_source INT, candidate_target INT, candidate_cost BIGINT, candidate_path STRING")
    assert sorted(rows(op.drop_used_edge(frontier, best))) == [(1, 3, 9), (4, 2, 1)]


def test_plans_of_steps_do_not_grow(make_edges):
    edges = make_edges(both_ways(WEIGHTED_PAIRS))
    paths, frontier = op.initial_paths(edges, 1), op.initial_frontier(edges, 1)
    leaves = []
    for _ in range(4):
        paths, frontier = op.advance(edges, paths, frontier)
        leaves.append(len(frontier._jdf.queryExecution().optimizedPlan().collectLeaves().toList().mkString("\n").split("\n")))
    assert len(set(leaves)) == 1


def test_a_long_chain(make_edges, rows):
    """Many hops: the texts grow once, at the end."""
    edges = [(k, k + 1, 1) for k in range(60)]
    found = rows(op.shortest_paths(make_edges(edges), 0, include_sinks=True))
    assert found == [(k, k, "-".join(map(str, range(k + 1)))) for k in range(61)]


def test_only_hubs_are_written_and_once(make_edges, rows, monkeypatch):
    from velograph.operators import adjacency

    tables = []
    write = adjacency.written
    monkeypatch.setattr(adjacency, "written", lambda df: tables.append(write(df)) or tables[-1])
    data = [(1, k % 40, 1) for k in range(100)] + [(2, k, 1) for k in range(5)]
    assert len(rows(op.build_adjacency(make_edges(data), 1000))) == 40 and tables == []
    got = rows(op.build_adjacency(make_edges(data), 30))
    assert [len(n) for i, _, _, n in sorted(got) if i == 1] == [30, 30, 30, 10]
    assert [{(r["source"], r["copies"]) for r in t.collect()} for t in tables] == [{(1, 2), (1, 3)}]
