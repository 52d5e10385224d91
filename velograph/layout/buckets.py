"""Written tables that are hashed on a key, so that joins and groupings on it move none of their rows.

A loop keeps its large tables here: they are columns in files that all executors share, so nothing has to
be made again when an executor is lost, and each round reads them where they are. Only what a round
makes anew is shuffled, to the tables' buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from velograph.layout.lineage import ensure_checkpoint_dir

# Narrow rows that make a bucket of about 128 MB, and rows that are worth a task where cores are idle.
ROWS_PER_BUCKET = 5_000_000
ROWS_PER_CORE = 200_000


def buckets_for(spark: SparkSession, rows: int) -> int:
    """Buckets for so many narrow rows: by size, but small data is spread over the cores there are."""
    idle = min(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_CORE))
    return max(1, -(-rows // ROWS_PER_BUCKET), idle)


class BucketedTables:
    """Tables of ``buckets`` buckets each, under a folder of their own.

    They are read in a session of their own, which has the caller's settings but as many shuffle
    partitions as there are buckets: what is shuffled on the key then meets the tables in place.
    With ``folder`` the tables stay there for a later run, else ``close`` deletes them.
    """

    def __init__(self, spark: SparkSession, buckets: int, folder: str | None = None) -> None:
        ensure_checkpoint_dir(spark)
        self.spark, self.buckets, self.kept = spark, buckets, folder is not None
        self.folder = folder or f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/buckets-{uuid4().hex}"
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._files = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if not self.kept:
            self._files.deleteOnExit(self._path)
        self._run, self._names = uuid4().hex[:12], {}
        self.session = spark.newSession()
        for name, value in spark.conf.getAll.items():
            if self.session.conf.isModifiable(name):
                self.session.conf.set(name, value)
        self.session.conf.set("spark.sql.shuffle.partitions", buckets)
        # A bucket written as one sorted file is read as sorted.
        self.session.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        # Whether a bucket is read as such must not hang on the plan around it.
        self.session.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")

    def place(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """``df`` with its rows where they belong, sorted, as a table of these keys wants them."""
        return df.repartition(self.buckets, *keys).sortWithinPartitions(*keys)

    def write(self, table: str, df: DataFrame, keys: Sequence[str], parts: Sequence[str] = ()) -> None:
        """Add the rows of ``df`` to ``table``, hashed on ``keys``, in folders by the values of ``parts``."""
        writer = df.write.format("parquet").mode("append").option("compression", "zstd")
        writer = writer.option("path", f"{self.folder}/{table}").bucketBy(self.buckets, *keys).sortBy(*keys)
        writer = writer.partitionBy(*parts) if parts else writer
        name = self._names.setdefault(table, f"velograph_{table}_{self._run}")
        writer.saveAsTable(name)
        self.session.catalog.refreshTable(name)

    def find(self, table: str, columns: str, keys: Sequence[str], parts: Sequence[str] = ()) -> None:
        """Take up a table that an earlier run left in the folder."""
        name = self._names.setdefault(table, f"velograph_{table}_{self._run}")
        by = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
        listed = ", ".join(f"`{k}`" for k in keys)
        self.session.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet {by} CLUSTERED BY ({listed}) SORTED BY ({listed}) "
            f"INTO {self.buckets} BUCKETS LOCATION '{self.folder}/{table}'"
        )
        if parts:
            self.session.catalog.recoverPartitions(name)

    def read(self, table: str) -> DataFrame:
        return self.session.table(self._names[table])

    def exists(self, name: str) -> bool:
        """Whether the folder holds a file or folder of this name."""
        return self._files.exists(self._path.suffix(f"/{name}"))

    def delete(self, name: str) -> None:
        """Delete one file or folder under the tables' folder."""
        self._files.delete(self._path.suffix(f"/{name}"), True)

    def drop(self, table: str) -> None:
        self.session.sql(f"DROP TABLE IF EXISTS {self._names.pop(table)}")
        self.delete(table)

    def hand_back(self, df: DataFrame) -> DataFrame:
        """``df`` written as columns and read in the caller's session; the files go when the session's JVM ends."""
        path = self._path.getParent() if not self.kept else self._path
        path = f"{path.toString()}/result-{uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        self._files.deleteOnExit(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        """Forget the tables, and delete them unless their folder was given."""
        for name in self._names.values():
            self.session.sql(f"DROP TABLE IF EXISTS {name}")
        self._names.clear()
        if not self.kept:
            self._files.delete(self._path, True)
