"""From text files to the listings of the known results."""

from test_graph import PAIRS, WEIGHTED_PAIRS, both_ways
from test_sources import TRIPS

from velograph import programs
from velograph.sources import row_listing, write_listing

# The result listings for the two fixture graphs.
RANK_LINES = """\
id=6; pagerank=1.69
id=3; pagerank=1.41
id=2; pagerank=1.2
id=4; pagerank=0.93
id=1; pagerank=0.89
id=7; pagerank=0.87
id=5; pagerank=0.64
id=8; pagerank=0.38
"""
PATH_LINES = """\
Row(id=1, cost=0, path='1')
Row(id=2, cost=3, path='1-2')
Row(id=3, cost=4, path='1-3')
Row(id=4, cost=5, path='1-2-4')
Row(id=5, cost=6, path='1-2-4-5')
Row(id=6, cost=10, path='1-2-4-5-6')
"""


def edge_folder(tmp_path, pairs):
    """Edge files, split in two."""
    lines = [f"{s} {t} {w}\n" for s, t, w in both_ways(pairs)]
    folder = tmp_path / "edges"
    folder.mkdir()
    (folder / "a.txt").write_text("".join(lines[::2]))
    (folder / "b.txt").write_text("".join(lines[1::2]))
    return str(folder)


def check_against(spark, tmp_path, lines, expected):
    """Write ``lines`` and compare the written listing with the expected text."""
    assert [r.line for r in lines.collect()] == expected.splitlines()
    (tmp_path / "expected.txt").write_text(expected)
    write_listing(lines, str(tmp_path / "actual"))
    result = programs.check(spark, str(tmp_path / "expected.txt"), str(tmp_path / "actual")).first()
    assert result.passed and result.left_rows == len(expected.splitlines())


def test_rank_listing(spark, tmp_path):
    lines = programs.rank_lines(spark, edge_folder(tmp_path, PAIRS), 0.15, 3)
    check_against(spark, tmp_path, lines, RANK_LINES)


def test_path_listing(spark, tmp_path):
    paths = programs.paths_from(spark, edge_folder(tmp_path, WEIGHTED_PAIRS), 1)
    check_against(spark, tmp_path, row_listing(paths), PATH_LINES)


def test_trip_programs(spark, tmp_path):
    (tmp_path / "trips.csv").write_text(TRIPS)
    folder = str(tmp_path)
    assert [tuple(r) for r in programs.stations(spark, folder).collect()] == [
        ("A St", 2, 1), ("B St", 1, 3), ("C St", 1, 0)]
    assert str(programs.top_bikes(spark, folder, 1).first()) == "Row(bike_id=7, totalTime=2100, numTrips=3)"
    assert [tuple(r) for r in programs.bike_moves(spark, folder, 7).collect()] == [
        ("2019/05/06 08:10:00", "B St", "2019/05/06 09:00:00", "C St")]
