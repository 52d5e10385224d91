import math
"""Column functions against their plain Python meaning."""

import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from velograph.functions import decimal_text, rank_line, round_exact, row_line, squeeze

# Exact halves, values stored just below or above a half, and ordinary ones.
HALVES = [0.125, 0.375, 0.625, 2.675, 0.575, 1.005, 2.5, 1.115, 0.145, 0.155, 0.0, 1.0, 12345678.125]


def test_round_exact_is_python_round(spark):
    draw = random.Random(3)
    values = HALVES + [draw.randrange(10**7) / 1000 for _ in range(3000)]
    values += [draw.uniform(0, 10**6) for _ in range(1000)]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    for places in (0, 1, 2, 3):
        got = df.select("v", round_exact(F.col("v"), places).alias("r")).collect()
        assert [r for r in got if r.r != round(r.v, places)] == []


def test_round_exact_keeps_null(spark):
    df = spark.createDataFrame([(None,)], "v DOUBLE")
    assert df.select(round_exact(F.col("v"))).first()[0] is None


def test_decimal_text_is_python_str(spark):
    values = [1.2, 1.0, 0.0, 0.01, 1.69, 10.0, 100.5, 12345678.25, 123456789012.0]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    assert [r[0] for r in df.select(decimal_text(F.col("v"))).collect()] == [str(v) for v in values]


def test_rank_line(spark):
    df = spark.createDataFrame([(2, 1.2), (10, 3.0)], "id INT, pagerank DOUBLE")
    lines = [r[0] for r in df.select(rank_line(F.col("id"), F.col("pagerank"))).collect()]
    assert lines == ["id=2; pagerank=1.2", "id=10; pagerank=3.0"]


def test_squeeze(spark):
    texts = ["  a  b c ", "\ta\tb\r", "", "   ", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    expected = [t.strip().replace(" ", "") for t in texts]
    assert [r[0] for r in df.select(squeeze(F.col("t"))).collect()] == expected


def test_row_line_is_printed_row(spark):
    data = [(1, 5, "1-2", True), (2, None, "it's", False), (3, 0, 'say "hi"', None),
            (4, 1, "both ' and \"", True), (5, 1, "back\\slash", True), (6, 1, None, True)]
    df = spark.createDataFrame(data, "id INT, cost BIGINT, path STRING, ok BOOLEAN")
    expected = [str(Row(id=a, cost=b, path=c, ok=d)) for a, b, c, d in data]
    assert [r[0] for r in df.select(row_line(df)).collect()] == expected


def test_row_line_refuses_other_types(spark):
    with pytest.raises(TypeError):
        row_line(spark.createDataFrame([(1.5,)], "v DOUBLE"))


def test_rounding_of_odd_values(spark, rows):
    values = [float("inf"), -float("inf"), 1e18, -1e300, 1e300, 9.3e16, 2.0**52 + 1, -2.675, -0.005, 1e13 + 0.005, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    assert [r[0] for r in rows(df.select(round_exact(F.col("v"))))] == [round(v, 2) for v in values]
    assert math.isnan(spark.sql("SELECT double('NaN') AS v").select(round_exact(F.col("v"))).first()[0])


def test_squeeze_strips_every_kind_of_space(spark):
    df = spark.createDataFrame([("\u3000\u1680 a \u2003\u202f",)], "v STRING")
    assert df.select(squeeze(F.col("v"))).first()[0] == "a"
