"""Comparison of results."""

import pytest
from pyspark.sql import functions as F

from velograph import operators as op
from velograph.layout import number_rows
from velograph.sources import read_listing

SCHEMA = "k INT, v STRING"


@pytest.fixture
def make(spark):
    return lambda data: spark.createDataFrame(data, SCHEMA)


@pytest.fixture
def listing(spark, tmp_path):
    def write(name, text):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return read_listing(spark, str(tmp_path / name))

    return write


@pytest.mark.parametrize("actual,differing,passed", [
    ("Row(a=1)\nRow(a=2)\n", 0, True),
    ("Row(a=1)   \n Row(a = 2)", 0, True),
    ("Row(a=2)\nRow(a=1)\n", 2, False),
    ("Row(a=1)\nRow(a=3)\n", 1, False),
    ("Row(a=1)\n", 1, False),
    ("Row(a=1)\n\nRow(a=2)\n", 2, False),
    ("Row(a=1)\nRow(a=2)\n\n", 1, False),
    ("", 2, False),
])
def test_listings_line_by_line(listing, actual, differing, passed):
    result = op.diff_listings(listing("expected", "Row(a=1)\nRow(a=2)\n"), listing("actual", actual)).first()
    assert (result.left_rows, result.differing_rows, result.passed) == (2, differing, passed)


def test_position_needs_no_input_order(make, rows):
    left = make([(i, f"v {i}") for i in range(1000)]).repartition(7)
    right = make([(i, f"v{i}") for i in reversed(range(1000))])
    assert rows(op.diff_by_position(left, right, ["k"], ["k", "v"])) == [(1000, 1000, 0, True)]


def test_position_shifts_after_a_missing_row(make, rows):
    left, right = make([(i, "x") for i in range(10)]), make([(i, "x") for i in range(10) if i != 6])
    assert rows(op.diff_by_position(left, right, ["k"], ["k", "v"])) == [(10, 9, 4, False)]


def test_key_comparison(make, rows):
    left = make([(1, "a"), (2, "b"), (3, None), (None, "n")])
    right = make([(1, "a"), (2, "B"), (3, None), (4, "d"), (None, "n")])
    assert rows(op.diff_by_key(left, right, ["k"])) == [(4, 5, 2, False)]
    assert rows(op.diff_by_key(left, left, ["k"])) == [(4, 4, 0, True)]


def test_key_comparison_tells_a_null_row_from_no_row(make, rows):
    assert rows(op.diff_by_key(make([(1, None)]), make([]), ["k"])) == [(1, 0, 1, False)]


def test_multiset_comparison(make, rows):
    left, right = make([(1, "a")] * 3 + [(2, None)]), make([(2, None), (1, "a"), (3, "c")])
    assert rows(op.diff_as_multiset(left, right)) == [(4, 3, 3, False)]
    left_only, right_only = left.exceptAll(right).count(), right.exceptAll(left).count()
    assert left_only + right_only == 3
    assert rows(op.diff_as_multiset(left, left.orderBy("v"))) == [(4, 4, 0, True)]


def test_comparison_of_nothing(make, rows):
    empty = make([])
    for result in (op.diff_as_multiset(empty, empty), op.diff_by_key(empty, empty, ["k"]),
                   op.diff_by_position(empty, empty, ["k"], ["k"])):
        assert rows(result) == [(0, 0, 0, True)]


def test_numbering_is_dense_and_ordered(spark):
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 AS k").repartition(13)
    got = {r.k: r.position for r in number_rows(df, ["k"], ["k"]).collect()}
    assert got == {k: k + 1 for k in range(5000)}


def test_numbering_splits_equal_rows(spark):
    """With the merging of small partitions off, as large ones would be left alone anyway."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = number_rows(spark.range(4000).selectExpr("1 AS k"), ["k"], ["k"])
        sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.position for r in df.collect()) == list(range(1, 4001))
    assert len(sizes) == 8 and max(sizes) < 1000


def test_keyed_comparison_is_of_values_as_they_are(spark):
    left = spark.createDataFrame([(1, "a b"), (2, None)], "k INT, v STRING")
    assert not op.diff_by_key(left, spark.createDataFrame([(1, "ab"), (2, None)], "k INT, v STRING"), ["k"]).first()["passed"]
    assert op.diff_by_key(left, left, ["k"]).first()["passed"]


@pytest.mark.parametrize("other", ["k INT, v STRING, extra INT", "k BIGINT, v STRING", "k INT"])
def test_other_columns_are_refused(spark, other):
    left, right = spark.createDataFrame([], "k INT, v STRING"), spark.createDataFrame([], other)
    for compare in (lambda: op.diff_by_key(left, right, ["k"]), lambda: op.diff_as_multiset(left, right)):
        with pytest.raises(ValueError, match="columns differ"):
            compare()


def test_very_many_copies_of_a_row(spark, rows):
    """A million copies are one row from the first step on, on either side and next to others."""
    def side(copies, after):
        head = spark.range(copies).select(F.lit(1).alias("k"), F.lit("copy").alias("v"))
        return head.unionByName(spark.range(after).select((F.col("id") + 2).cast("int").alias("k"), F.lit("x").alias("v")))

    assert rows(op.diff_by_position(side(1_000_000, 5), side(1_000_000, 5), ["k"], ["v"])) == [(1_000_005, 1_000_005, 0, True)]
    assert rows(op.diff_by_position(side(1_000_000, 5), side(999_999, 5), ["k"], ["v"])) == [(1_000_005, 1_000_004, 2, False)]
    assert rows(op.diff_by_position(side(1_000_000, 0), side(3, 7), ["k"], ["v"])) == [(1_000_000, 10, 999_997, False)]


def test_each_side_is_written_once(make, rows, monkeypatch):
    from velograph.layout import positions

    counts = []
    write = positions.written
    monkeypatch.setattr(positions, "written", lambda df: counts.append(write(df)) or counts[-1])
    monkeypatch.setattr(positions, "cut_lineage", None)
    left, right = make([(k % 7, "x") for k in range(70)]), make([(k, "x") for k in range(9)])
    assert rows(op.diff_by_position(left, right, ["k"], ["k", "v"])) == [(70, 9, 69, False)]
    assert [df.count() for df in counts] == [7, 9]


@pytest.mark.parametrize("stretch", [1, 3, 1 << 18])
def test_runs_cut_at_any_position(make, rows, monkeypatch, stretch):
    from velograph.operators import compare

    monkeypatch.setattr(compare, "_STRETCH", stretch)
    left = [(1, "a")] * 4 + [(2, "b")] * 2 + [(3, None)] * 3 + [(4, "d")]
    right = [(1, "a")] * 3 + [(2, "b")] * 3 + [(3, None)] * 2
    differing = sum(x != y for x, y in zip(left, right, strict=False)) + len(left) - len(right)
    assert rows(op.diff_by_position(make(left), make(right), ["k"], ["v"])) == [(10, 8, differing, False)]
    assert rows(op.diff_by_position(make([]), make(right), ["k"], ["v"])) == [(0, 8, 8, False)]
    assert rows(op.diff_by_position(make([]), make([]), ["k"], ["v"])) == [(0, 0, 0, True)]


@pytest.mark.parametrize("compare", ["diff_as_multiset", "diff_by_position"])
def test_rows_of_a_task_do_not_follow_the_size_of_the_sides(spark, rows, monkeypatch, compare):
    """Partitions are put together up to a fixed size only, not to one per core, and settings are put back."""
    from velograph.layout import tasks
    from velograph.operators import compare as module

    parts, verdict = [], module._verdict
    monkeypatch.setattr(tasks, "SHUFFLED_BYTES", 1 << 14)
    monkeypatch.setattr(module, "_verdict", lambda df, *sums: parts.append(df.rdd.getNumPartitions()) or verdict(df, *sums))
    monkeypatch.setattr(module, "_STRETCH", 1 << 10)
    left = spark.range(300_000).selectExpr("CAST(id AS INT) AS k", "hash(id) AS v")
    asked = () if compare == "diff_as_multiset" else (["k"], ["k", "v"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    before = spark.conf.getAll
    try:
        assert rows(getattr(op, compare)(left, left.filter("k <> 299999"), *asked)) == [(300_000, 299_999, 1, False)]
        assert parts[0] > 8 and spark.conf.getAll == before
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")


def test_numbers_are_compared_as_numbers(spark, rows, monkeypatch):
    """Only texts, and numbers that the other side has as another type, are kept as texts; ties go by text."""
    from velograph.layout import positions

    kept, write = [], positions.written
    monkeypatch.setattr(positions, "written", lambda df: kept.append(write(df)) or kept[-1])
    left = spark.createDataFrame([(1, 9, "a b"), (1, 10, "c"), (None, None, None)], "k BIGINT, n INT, v STRING")
    right = spark.createDataFrame([(1, 10, "c"), (1, 9, " ab"), (None, None, None)], "k BIGINT, n INT, v STRING")
    assert rows(op.diff_by_position(left, right, ["k"], ["k", "n", "v"])) == [(3, 3, 0, True)]
    assert [t for _, t in kept[0].dtypes] == ["bigint", "int", "string", "bigint", "bigint", "int"]
    by_text = kept[0].filter("_order0 = 1").orderBy("_before")
    assert [r[1] for r in by_text.collect()] == [10, 9]
    wide = right.withColumn("n", F.col("n").cast("bigint"))
    assert rows(op.diff_by_position(left, wide, ["k"], ["k", "n", "v"])) == [(3, 3, 0, True)]
    assert kept[2].dtypes[1][1] == "string"
