"""Global row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velograph.layout.lineage import cut_lineage, written

# monotonically_increasing_id() keeps the row's index within its partition in the low 33 bits.
_INDEX_BITS = 33


# Column that with_row_ids adds.
ROW_ID = "_row"


def with_row_ids(df: DataFrame) -> DataFrame:
    """Add a column that tells even equal rows apart, as a last key for range partitioning.

    With it any number of copies of a row splits over tasks. The ids depend on the order in which
    the rows arrive, so they are written before use: a retried task must not draw them anew.
    """
    return cut_lineage(df.withColumn(ROW_ID, F.monotonically_increasing_id()))


def number_rows(df: DataFrame, order_by: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` and ``position``: 1, 2, 3, ... in the order of ``order_by``.

    The rows are range-sorted over all tasks and written once; each row then knows its index
    within its partition, and a table with one row per partition supplies the offsets.
    """
    sorted_rows = with_row_ids(df).orderBy(*order_by, ROW_ID)
    placed = cut_lineage(
        sorted_rows.select(
            *keep,
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND((1 << _INDEX_BITS) - 1).alias("_index"),
        )
    )
    # One row per partition: small whatever the data, hence the unpartitioned window and broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *keep, (F.col("_offset") + F.col("_index") + 1).alias("position")
    )


def number_runs(
    df: DataFrame, order_by: Sequence[str], keep: Sequence[str], ties: Sequence[Column] | None = None
) -> DataFrame:
    """Equal rows as one: the columns ``keep``, ``copies``, and ``first``, the position of the first copy.

    Positions count from 0 in the order of ``order_by``, then of ``ties``, which are ``keep`` unless given.
    Equal rows are combined before the shuffle, so any number of copies is one row from then on. The runs
    are range-sorted over all tasks and written once, each with the copies before it in its partition, which
    are summed up in passing; one offset per partition gives the positions.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            copies = batch.column("copies").to_numpy()
            upto = before + np.cumsum(copies)
            added = [pa.array(upto - copies), pa.array(np.full(len(copies), part, "int32"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "_before", "_part"])
            before = int(upto[-1]) if len(copies) else before

    keys = list(dict.fromkeys([*order_by, *keep]))
    runs = df.groupBy(*keys).agg(F.count("*").alias("copies"))
    schema = T.StructType([*runs.schema.fields, T.StructField("_before", T.LongType()), T.StructField("_part", T.IntegerType())])
    placed = written(runs.orderBy(*order_by, *(keep if ties is None else ties)).mapInArrow(summed, schema))
    # One row per partition: small whatever the data, hence the unpartitioned window and broadcast.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.sum("copies").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return placed.join(F.broadcast(offsets), "_part").select(
        *keep, "copies", (F.col("_offset") + F.col("_before")).alias("first")
    )
