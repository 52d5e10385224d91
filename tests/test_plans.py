"""Physical plans: what is read, shuffled and sorted."""

import pytest

from velograph import operators as op
from velograph.plans import QUERIES

SF = "/root/testdata/sf0.001"
TRIPS = (
    "bike_id INT, start_time STRING, stop_time STRING, trip_duration INT, "
    "start_station_name STRING, stop_station_name STRING, user_type STRING, trip_id INT"
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def trips(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trips") / "t")
    spark.createDataFrame([(1, "1", "2", 3, "A", "B", "x", i) for i in range(50)], TRIPS).write.parquet(path)
    return spark.read.parquet(path)


def test_balance_reads_two_columns_once_and_shuffles_once(trips):
    text = plan(op.station_trip_balance(trips))
    assert text.count("FileScan") == 1
    assert text.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<start_station_name:string,stop_station_name:string>" in text


def test_top_n_needs_no_global_sort(trips):
    text = plan(op.top_n_vehicles(trips, 3))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text
    assert "ReadSchema: struct<bike_id:int,trip_duration:int,trip_id:int>" in text


def test_one_vehicle_is_filtered_in_the_scan(trips):
    text = plan(op.vehicle_relocations(trips, 1))
    assert "EqualTo(bike_id,1)" in text
    assert "user_type" not in text and "trip_duration" not in text


def test_relocations_window_is_partitioned(trips):
    text = plan(op.vehicle_relocations(trips))
    assert "SinglePartition" not in text
    window = next(line for line in text.splitlines() if "Window [" in line)
    assert window.count("lag(") == 2


def exchanges(df):
    return [line.strip(" :+-|") for line in plan(df).splitlines() if "Exchange" in line]


def test_pagerank_keeps_its_edges_in_place(spark):
    """The edges are hashed when written; joining ranks to them moves the ranks only."""
    from velograph.layout import heavy_keys, sliced_table

    edges = spark.range(5000).selectExpr("id % 50 AS source", "id % 77 AS target")
    for limit in (10**6, 60):
        sliced = sliced_table(edges, heavy_keys(edges, "source", limit), ["target"], "edges")
        session = sliced.tables.session
        ranks = session.range(50).selectExpr("id AS source", "1.0D AS share").repartition(3)
        joined = sliced.rows.hint("merge").join(sliced.spread(ranks), sliced.join_keys)
        assert joined.count() == 5000
        assert "velograph_edges" in plan(joined) and not any("target" in e for e in exchanges(joined))
        # Read as sorted: the edges' side of the join has no sort either.
        assert all("target" not in line for line in plan(joined).splitlines() if " Sort [" in line)
        sliced.tables.close()


def test_an_iteration_of_pagerank_shuffles_partial_sums_only(spark, monkeypatch):
    from velograph.layout.buckets import BucketedTables

    monkeypatch.setattr("velograph.layout.buckets.ROWS_PER_CORE", 1000)
    seen = []
    monkeypatch.setattr(BucketedTables, "hand_back", lambda self, df: seen.append(exchanges(df)) or df)
    op.pagerank(spark.range(5000).selectExpr("id % 50 AS source", "id % 77 AS target"), max_iterations=3)
    hashed = [e for e in seen[0] if "BroadcastExchange" not in e]
    assert len(hashed) == 3 and all("hashpartitioning(target" in e for e in hashed)


def test_a_round_of_the_path_search_moves_candidates_only(spark, monkeypatch):
    from velograph.layout import heavy_keys, sliced_table
    from velograph.operators.paths import _first_state, _improvements

    monkeypatch.setattr("velograph.layout.buckets.ROWS_PER_CORE", 1000)
    edges = spark.range(5000).selectExpr("id % 50 AS source", "id % 77 AS target", "id % 9 AS weight")
    sliced = sliced_table(edges, heavy_keys(edges, "source", 10**6), ["target"], "edges")
    _first_state(sliced.tables, "bigint", 1)
    known = sliced.tables.read("known0")
    better = _improvements(sliced, known, known.filter("round = 0 AND improved"), 0)
    text = plan(better)
    hashed = [e for e in exchanges(better) if "BroadcastExchange" not in e]
    assert len(hashed) == 1 and "hashpartitioning(id" in hashed[0]
    # The one exchange is below the join with the known nodes, on the side of the edges.
    above, below = text.split("Exchange hashpartitioning", 1)
    assert "velograph_edges" not in above and "velograph_edges" in below
    assert text.count("Bucketed: true") == 3
    sliced.tables.close()


@pytest.mark.parametrize("name", ["station_trip_balance", "vehicle_relocations_all", "shortest_paths",
                                  "pagerank_in", "adjacency", "result_diff", "unvisited_targets"])
def test_no_query_pairs_everything_with_everything(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
