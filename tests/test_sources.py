"""Text readers and writers on temporary files."""

import pytest
from pyspark.sql import Observation

from velograph import operators as op
from velograph.sources.listings import LINE_ORDER
from velograph.sources import (
    malformed_edges,
    malformed_trips,
    rank_listing_lines,
    read_edges,
    read_edges_strict,
    read_listing,
    read_trips,
    rejected_edges,
    row_listing,
    write_listing,
)

TRIPS = """\
2019/05/06 08:00:00,2019/05/06 08:10:00,600,1,A St,40.7,-74.0,2,B St,40.8,-74.0,7,Subscriber,1980,1,1
2019/05/06 09:00:00,2019/05/06 09:05:00,300,3,C St,40.6,-73.9,1,A St,40.7,-74.0,7,Subscriber,1990,2,2
2019/05/06 10:00:00,2019/05/06 10:20:00,1200,1,A St,40.7,-74.0,2,B St,40.8,-74.0,7,Customer,1985,1,3
2019/05/06 11:00:00,2019/05/06 11:01:40,100,2,B St,40.8,-74.0,2,B St,40.8,-74.0,8,Subscriber,1970,1,4
"""


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, text in files.items():
            (tmp_path / f"{name}.txt").write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def test_trip_files_end_to_end(spark, folder, rows):
    trips = read_trips(spark, folder(a=TRIPS))
    balance = [("A St", 2, 1), ("B St", 1, 3), ("C St", 1, 0)]
    assert rows(op.station_trip_balance(trips)) == balance
    assert rows(op.station_trip_balance_join(trips)) == balance
    assert op.station_trip_balance(trips).dtypes == [
        ("station", "string"), ("num_departure_trips", "bigint"), ("num_arrival_trips", "bigint")]
    top = op.top_n_vehicles(trips, 1)
    assert rows(top) == [(7, 2100, 3)]
    assert top.dtypes == [("bike_id", "bigint"), ("totalTime", "bigint"), ("numTrips", "bigint")]
    moves = op.vehicle_relocations(trips, 7)
    assert rows(moves) == [("2019/05/06 08:10:00", "B St", "2019/05/06 09:00:00", "C St")]
    assert [t for _, t in moves.dtypes] == ["string"] * 4


def test_trip_types(spark, folder):
    types = dict(read_trips(spark, folder(a=TRIPS)).dtypes)
    assert len(types) == 16
    assert types["start_time"] == "string" and types["trip_duration"] == "int"
    assert types["start_station_latitude"] == "float" and types["trip_id"] == "bigint"


def test_quotes_are_ordinary_characters(spark, folder):
    line = '2019/01/01 00:00:00,2019/01/01 00:01:00,60,1,"A, St",1,2,3,B St,4,5,6,x,1,1,9'
    trip = read_trips(spark, folder(a=line)).first()
    assert trip["start_station_name"] == '"A'


def test_malformed_trip_fields_become_null(spark, folder):
    good = TRIPS.splitlines()[0]
    bad_number = good.replace(",600,", ",soon,")
    short = "2019/05/06 08:00:00,2019/05/06 08:10:00,600"
    trips = read_trips(spark, folder(a="\n".join([bad_number, short]))).collect()
    assert trips[0]["trip_duration"] is None and trips[0]["trip_id"] == 1
    assert trips[1]["trip_duration"] == 600 and trips[1]["bike_id"] is None


def test_all_files_of_a_folder_but_hidden_ones(spark, folder, rows):
    path = folder(a="1 2 3\n", b="2 3 4\n")
    with open(path + "/.hidden", "w") as hidden:
        hidden.write("9 9 9\n")
    for reader in (read_edges, read_edges_strict):
        assert sorted(rows(reader(spark, path))) == [(1, 2, 3), (2, 3, 4)]


def test_loose_edges_become_null(spark, folder, rows):
    edges = read_edges(spark, folder(a="1 2 3\nx 2 3\n1 2\n"))
    assert rows(edges) == [(1, 2, 3), (None, 2, 3), (1, 2, None)]
    assert edges.dtypes == [("source", "bigint"), ("target", "bigint"), ("weight", "int")]


def test_strict_edges_strip_the_line_and_ignore_the_weight(spark, folder, rows):
    assert rows(read_edges_strict(spark, folder(a=" 1 2 3 \n4 5 0.5\n"))) == [(1, 2, 3), (4, 5, None)]


@pytest.mark.parametrize("line", ["1 2", "1 2 3 4", "1  2 3", "", "a 2 3", "1 2,3"])
def test_strict_edges_fail_on_other_lines(spark, folder, line):
    path = folder(a=f"1 2 3\n{line}\n4 5 6\n")
    with pytest.raises(Exception, match="edge line"):
        read_edges_strict(spark, path).collect()
    # Also when a query reads one column only.
    with pytest.raises(Exception, match="edge line"):
        op.out_degree(read_edges_strict(spark, path)).collect()


def test_listing_round_trip(spark, tmp_path):
    ranks = spark.createDataFrame([(6, 1.69), (3, 1.41), (2, 1.2)], "id INT, pagerank DOUBLE")
    path = str(tmp_path / "ranks")
    write_listing(rank_listing_lines(op.rank_listing(ranks)), path)
    back = read_listing(spark, path).orderBy("file", "block_start", "line_id")
    assert [r.line for r in back.collect()] == [
        "id=6; pagerank=1.69", "id=3; pagerank=1.41", "id=2; pagerank=1.2"]


def test_row_listing_matches_printed_rows(spark, folder):
    trips = read_trips(spark, folder(a=TRIPS))
    for result in (op.top_n_vehicles(trips, 5), op.vehicle_relocations(trips, 7)):
        assert [r.line for r in row_listing(result).collect()] == [str(r) for r in result.collect()]


def test_listing_lines_keep_their_order_over_splits(spark, tmp_path):
    """Small splits, the last one shorter: the order columns still give file order."""
    lines = [f"line {i}" for i in range(5000)]
    (tmp_path / "long.txt").write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        listing = read_listing(spark, str(tmp_path))
        assert listing.rdd.getNumPartitions() > 5
        ordered = listing.orderBy("file", "block_start", "line_id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.line for r in ordered] == lines


def test_ids_past_32_bits_survive(spark, folder, rows):
    path = folder(a="3000000000 1 1\n1 3000000000 2\n")
    for reader in (read_edges, read_edges_strict):
        edges = reader(spark, path)
        assert sorted(rows(edges)) == [(1, 3000000000, 2), (3000000000, 1, 1)]
        assert sorted(r[0] for r in rows(op.pagerank(edges))) == [1, 3000000000]
        assert rows(op.shortest_paths(edges, 1)) == [(1, 0, "1"), (3000000000, 2, "1-3000000000")]


def test_part_files_follow_their_number(spark, tmp_path, rows):
    for number in (100000, 99999, 3):
        (tmp_path / f"part-{number:05d}-x.txt").write_text(f"{number}\n")
    (tmp_path / "other.txt").write_text("other\n")
    lines = read_listing(spark, str(tmp_path)).orderBy(*LINE_ORDER)
    assert [r["line"] for r in lines.collect()] == ["other", "3", "99999", "100000"]


def test_a_report_counts_what_became_null(spark, folder, rows):
    path = folder(a="1 2 3\n4 x 5\n6 7\n", b="8 9 10 11\n1 2 z\n")
    report = Observation()
    edges = read_edges(spark, path, report)
    assert edges.columns == ["source", "target", "weight"]
    assert sorted(rows(edges), key=repr) == sorted(rows(read_edges(spark, path)), key=repr)
    assert report.get == {"lines": 5, "malformed_lines": 4, "null_source": 0, "null_target": 1, "null_weight": 2}
    found = sorted((r["file"].rsplit("/", 1)[1], r["line_number"], r["line"]) for r in malformed_edges(spark, path).collect())
    assert found == [("a.txt", 2, "4 x 5"), ("a.txt", 3, "6 7"), ("b.txt", 1, "8 9 10 11"), ("b.txt", 2, "1 2 z")]


def test_a_report_of_trips(spark, folder):
    path = folder(a=TRIPS + TRIPS.splitlines()[0].replace(",600,", ",long,") + "\n")
    report = Observation()
    read_trips(spark, path, report).count()
    assert report.get["lines"] == 5 and report.get["malformed_lines"] == report.get["null_trip_duration"] == 1
    assert [(r["line_number"], ",long," in r["line"]) for r in malformed_trips(spark, path).collect()] == [(5, True)]


def test_rejected_lines_have_their_file_and_number(spark, folder, rows):
    many = "".join(f"{k} {k + 1} 1\n" for k in range(4000))
    path = folder(a="1 2 3\n\n4 5 6\nx 1 1\n", b=many + "7 8\n" + many, c="1 2 no\n")
    expected = [("a.txt", 2, "", "expected 3 fields"), ("a.txt", 4, "x 1 1", "no integer node"), ("b.txt", 4001, "7 8", "expected 3 fields")]
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for limit in (size, "5000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
            found = rejected_edges(spark, path)
            assert sorted((f.rsplit("/", 1)[1], n, line, why) for f, n, line, why in rows(found)) == expected
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_the_strict_error_names_file_and_line(spark, folder):
    path = folder(fine="1 2 3\n", faulty="1 2 3\n4 5\n")
    with pytest.raises(Exception, match=r"expected 3 fields in edge line: 4 5 \(.*faulty.txt, from byte 0\)"):
        read_edges_strict(spark, path).collect()
