"""Keeping a hot key from landing in one task.

A key is *heavy* when it has more rows than one task should take. Only heavy keys are treated
specially, so data without hot keys pays for one narrow counting pass and nothing else.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from velograph.layout.buckets import BucketedTables, buckets_for
from velograph.layout.lineage import cut_lineage

# A side of at most this many narrow rows (a key and a count, some tens of MB) may be broadcast.
BROADCAST_ROWS = 1_000_000

# Rows of one key that a single task may take.
ROWS_PER_TASK = 5_000_000


@dataclass
class HeavyKeys:
    """Keys with too many rows for one task: ``key, n_rows, slices``, and how many there are.

    ``total_rows`` is the number of rows of all keys, ``heavy_rows`` that of the heavy ones.
    """

    table: DataFrame
    key: str
    count: int
    total_rows: int
    heavy_rows: int

    def __bool__(self) -> bool:
        return self.count > 0

    @property
    def buckets(self) -> int:
        """Buckets to place the rows in: as many as their number is worth."""
        return buckets_for(self.table.sparkSession, self.total_rows)

    def for_join(self, *columns: str) -> DataFrame:
        """``columns`` of the table, broadcast when its counted size allows it.

        Beyond the limit the optimizer plans a shuffled join, whose skewed partitions adaptive
        execution splits.
        """
        narrow = self.table.select(*columns)
        return F.broadcast(narrow) if self.count <= BROADCAST_ROWS else narrow


def heavy_keys(df: DataFrame, key: str, rows_per_task: int) -> HeavyKeys:
    """Find the keys of ``df`` with more than ``rows_per_task`` rows.

    ``slices`` is the number of tasks to spread such a key over. The pass reads one column and
    combines before its shuffle, so a hot key costs it nothing. NULL is never a heavy key.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    observed = Observation()
    heavy = (
        counts.observe(observed, F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total"))
        .filter(F.col("n_rows") > rows_per_task)
        .withColumn("slices", F.ceil(F.col("n_rows") / rows_per_task).cast("int"))
    )
    # Written once: the counts are not made again for the keys that are heavy.
    heavy = cut_lineage(heavy)
    count, rows = heavy.agg(F.count("*"), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
    return HeavyKeys(heavy, key, count, observed.get["total"], rows)


@dataclass
class SlicedRows:
    """Rows in a written table, hashed on ``join_keys``: the key, and the slice where some key is heavy."""

    rows: DataFrame
    join_keys: list[str]
    heavy: HeavyKeys
    tables: BucketedTables

    def spread(self, df: DataFrame) -> DataFrame:
        """Copy each row of ``df``, one per key, to every slice of its key."""
        if not self.heavy:
            return df
        key = self.heavy.key
        last_slice = F.coalesce("slices", F.lit(1)) - 1
        return (
            df.join(self.heavy.for_join(key, "slices"), key, "left")
            .withColumn("slice", F.explode(F.sequence(F.lit(0), last_slice)))
            .drop("slices")
        )

    def description(self) -> dict:
        """What a later run needs to take the table up again, for ``sliced_table``."""
        return {
            "buckets": self.tables.buckets,
            "key": self.heavy.key,
            "heavy": self.heavy.count,
            "total_rows": self.heavy.total_rows,
            "heavy_rows": self.heavy.heavy_rows,
            "columns": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.rows.schema),
        }


def sliced_table(
    df: DataFrame | None, heavy: HeavyKeys | None, spread_by: list[str], name: str, folder: str | None = None,
    found: dict | None = None, spark: SparkSession | None = None,
) -> SlicedRows:
    """Write ``df`` hashed on its key, the rows of a heavy key being told apart by ``spread_by``.

    The slice is hashed rather than drawn at random, so that a retried task puts every row where
    it was before. With ``folder`` the table stays there for a later run, which passes the
    ``description`` that it kept as ``found``, and no rows.
    """
    if found is not None:
        tables = BucketedTables(spark, found["buckets"], folder)
        join_keys = [found["key"], "slice"] if found["heavy"] else [found["key"]]
        tables.find(name, found["columns"], join_keys)
        table = None
        if found["heavy"]:
            table = tables.session.read.parquet(f"{folder}/{name}-heavy")
        heavy = HeavyKeys(table, found["key"], found["heavy"], found["total_rows"], found["heavy_rows"])
        return SlicedRows(tables.read(name), join_keys, heavy, tables)
    key, join_keys = heavy.key, [heavy.key]
    tables = BucketedTables(df.sparkSession, heavy.buckets, folder)
    if heavy:
        join_keys = [key, "slice"]
        slice_no = F.pmod(F.xxhash64(*spread_by), F.col("slices")).cast("int")
        df = (
            df.join(heavy.for_join(key, "slices"), key, "left")
            .withColumn("slice", F.coalesce(slice_no, F.lit(0)))
            .drop("slices")
        )
        # The session of the tables reads the heavy keys from files, as a later run does.
        path = f"{tables.folder}/{name}-heavy"
        heavy.table.write.mode("overwrite").parquet(path)
        heavy = HeavyKeys(tables.session.read.parquet(path), key, heavy.count, heavy.total_rows, heavy.heavy_rows)
    tables.delete(name)
    tables.write(name, tables.place(df, join_keys), join_keys)
    return SlicedRows(tables.read(name), join_keys, heavy, tables)
