import pytest
from pyspark.sql import functions as F

from velograph.llm.common import Workspace, without_rows


@pytest.fixture
def numbered(spark):
    work = Workspace(spark)
    table = spark.range(0, 5000, 1, 7).select(
        F.col("id").cast("string").alias("part"), F.array("id").alias("key"), F.monotonically_increasing_id().alias("_row")
    )
    return work, work.keep(table)


@pytest.mark.parametrize("unwanted", ["part % 3 = 0", "part < 2000", "part = 4999", "true", "false"])
def test_unwanted_rows_go_and_all_others_stay_whole(numbered, unwanted):
    work, table = numbered
    found = without_rows(table, table.where(unwanted).select("_row"), "_row", work)
    assert found.schema == table.schema
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, table.where(f"NOT ({unwanted})").collect()))


def test_a_table_without_rows_has_none(spark):
    work = Workspace(spark)
    table = work.keep(spark.createDataFrame([], "text STRING, _row BIGINT"))
    assert without_rows(table, table.select("_row"), "_row", work).collect() == []


def test_rows_are_not_shuffled(numbered):
    work, table = numbered
    plan = without_rows(table, table.where("part < 9").select("_row"), "_row", work)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
