"""A list of finished rounds beside a loop's tables, from which a restarted driver goes on."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Rounds:
    """One small row per finished round, in ``folder``/rounds.

    A row is committed by Spark after the round's own tables are, so a round that was cut off is not
    listed, and whoever goes on deletes what it left.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._path = spark, f"{folder.rstrip('/')}/rounds"

    def add(self, state: dict) -> None:
        """List a round: ``state`` has its number as ``round`` and plain values besides."""
        row = self._spark.range(1).select(F.lit(state["round"]).alias("round"), F.lit(json.dumps(state)).alias("state"))
        row.coalesce(1).write.mode("append").parquet(self._path)

    def _listed(self) -> DataFrame | None:
        path = self._spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path)
        found = path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self._spark.read.schema("round INT, state STRING").parquet(self._path) if found else None

    def last(self) -> dict | None:
        """The state after the last finished round; none if there is no such round."""
        listed = self._listed()
        row = listed.orderBy(F.desc("round")).first() if listed is not None else None
        return json.loads(row["state"]) if row else None
