"""Reliable lineage cuts for iterative jobs."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; fall back to a temporary one in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="velograph-checkpoints-")
    context.setCheckpointDir(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder now and go on from the written rows.

    The written rows survive the loss of any executor, and a loop that cuts once per round keeps
    its plan at the size of one round.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written now, as compressed columns in the checkpoint folder, to be read more than once.

    Like a checkpoint it survives the loss of any executor, but readers take only the columns they
    need. The files go when the session's JVM ends.
    """
    return _written(df)[0]


@contextmanager
def written_for_now(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as ``written`` has it, for the time of a block; its files go at the end of that."""
    rows, path = _written(df)
    try:
        yield rows
    finally:
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _written(df: DataFrame) -> tuple[DataFrame, Any]:
    """The written rows, and the path of their folder."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/written-{uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder), path
