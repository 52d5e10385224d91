"""What the operators of this subpackage share: written tables, text batches, word hashes, groups."""

from __future__ import annotations

from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.layout.lineage import ensure_checkpoint_dir

# Text bytes that one step of a Python worker looks at together; one longer text goes alone.
SLICE_BYTES = 2 << 20

# Fixed value: monotonically_increasing_id counts the rows of a partition in so many lower bits.
_ROW_BITS = 33

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Table ``name`` of ``folder`` with the columns that it has."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Workspace:
    """Tables written between steps, in the folder that all executors share.

    A written table is read again after the loss of any executor. ``drop`` deletes one that is no
    longer in use; the rest goes when the session's JVM ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        ensure_checkpoint_dir(spark)
        self.spark = spark
        self.folder = f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/llm-{uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._path(self.folder).getFileSystem(self._hadoop()).deleteOnExit(self._path(self.folder))

    def _hadoop(self):
        return self.spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` now and go on from what was written."""
        path = f"{self.folder}/{uuid4().hex}"
        df.write.option("compression", "zstd").parquet(path)
        written = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(written)] = path
        return written

    def pass_on(self, table: DataFrame, view: DataFrame) -> DataFrame:
        """Let ``view``, which reads nothing but the written ``table``, be dropped in its place."""
        self._paths[id(view)] = self._paths.pop(id(table))
        return view

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that nothing will read again."""
        for table in tables:
            path = self._path(self._paths.pop(id(table)))
            path.getFileSystem(self._hadoop()).delete(path, True)


def file_system(folder: str):
    """The file system of a shared folder for files that Spark does not write itself, and the folder's path there.

    Fails at once, and says why, where the folder's scheme is not one that pyarrow opens.
    """
    from pyarrow import fs

    try:
        return fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "file://", 1))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError) as error:
        scheme = folder.partition(":")[0]
        raise ValueError(f"files cannot be written under spark.checkpoint.dir: pyarrow does not open {scheme!r}") from error


def without_rows(rows: DataFrame, unwanted: DataFrame, key: str, work: Workspace) -> DataFrame:
    """The written table ``rows`` without those whose ``key`` is in ``unwanted``, which holds no key twice.

    ``key`` holds numbers by ``monotonically_increasing_id``, given when ``rows`` was written, so that its upper
    bits tell the partition. Unwanted keys are written by partition; a task reads those of the partitions
    that it meets, one at a time. So only keys are shuffled, no other column of ``rows``, and nothing is broadcast. A
    partition's keys are fewer than its rows, which one task wrote. No unwanted keys leave all rows.
    """
    path, part = f"{work.folder}/{uuid4().hex}", F.shiftright(key, _ROW_BITS)
    by_part = unwanted.select(F.col(key).alias("key"), part.alias("part")).repartition("part")
    by_part.write.partitionBy("part").option("compression", "zstd").parquet(path)
    file_system(path)
    at = rows.columns.index(key)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyarrow import parquet as pq

        system, folder = file_system(path)
        known, gone = None, np.empty(0, dtype=np.int64)
        for batch in batches:
            keys = batch.column(at).to_numpy()
            parts = keys >> _ROW_BITS
            stays = np.ones(len(keys), dtype=bool)
            for one in np.unique(parts).tolist():
                if one != known:
                    found = system.get_file_info(fs.FileSelector(f"{folder}/part={one}", allow_not_found=True))
                    files = [f.path for f in found if f.base_name.endswith(".parquet")]
                    read = [pq.ParquetFile(f, filesystem=system).read(["key"]).column("key").to_numpy() for f in files]
                    known, gone = one, np.concatenate([np.empty(0, dtype=np.int64), *read])
                mine = parts == one
                stays[mine] = ~np.isin(keys[mine], gone)
            yield batch.filter(pa.array(stays))

    return rows.mapInArrow(task, rows.schema)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has at most ``limit`` bytes of ``column``, or one row."""
    sizes = batch.column(column).nbytes
    if sizes <= limit or batch.num_rows <= 1:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from slices(batch.slice(0, half), column, limit)
    yield from slices(batch.slice(half), column, limit)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The texts as UTF-8, nulls as empty ones."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def joined(texts: list[bytes], separator: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one buffer, each between separator bytes, and where each one begins.

    ``starts`` has one entry more than there are texts: where a further text would begin.
    """
    mark = bytes([separator])
    buffer = np.frombuffer(mark + mark.join(texts) + mark, dtype=np.uint8)
    starts = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return buffer, starts


def word_spans(buffer: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of word bytes; the buffer's ends are none."""
    inside = is_word[buffer].view(np.int8)
    edges = np.flatnonzero(np.diff(inside)) + 1
    return edges[0::2], edges[1::2]


_powers = np.ones(1, dtype=np.uint64)


def _power_table(length: int) -> np.ndarray:
    global _powers
    if len(_powers) < length:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.r_[np.uint64(1), np.full(2 * length, _MULTIPLIER)])
    return _powers


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers; one to one."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, from its bytes alone."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    table = _power_table(int(lengths.max()) + 1)
    at = place + np.repeat(starts, lengths)
    values = (buffer[at].astype(np.uint64) + np.uint64(1)) * table[place]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def lower_ascii() -> np.ndarray:
    """Table from byte to byte that lower-cases A-Z and leaves every other byte."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def connected_components(edges: DataFrame, work: Workspace) -> DataFrame:
    """Columns ``id`` and ``component``: the smallest id reachable over ``edges`` (u, v).

    Large-star and small-star rounds: every node links its larger neighbours to its smallest one,
    then its smaller neighbours to the smallest; the rounds end when only stars are left, after
    about log(n) of them. Minima and pairs are combined before each shuffle, minima are written
    before their join so that a node with very many links is split over tasks. A component's
    smallest id has no row of its own, as has no id without links.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
    current, state = _written_pairs(pairs, work)
    while True:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = work.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large, _ = _written_pairs(
            both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")), work
        )
        lower = work.keep(large.groupBy("a").agg(F.min("b").alias("m")))
        small = (
            large.join(lower, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(lower.select("a", F.col("m").alias("b")))
        )
        following, next_state = _written_pairs(small, work)
        work.drop(current, least, large, lower)
        current = following
        if next_state == state:
            return work.pass_on(current, current.select(F.col("a").alias("id"), F.col("b").alias("component")))
        state = next_state


def _written_pairs(pairs: DataFrame, work: Workspace) -> tuple[DataFrame, tuple[int, int]]:
    """Distinct pairs, written, with their count and a sum that tells sets of pairs apart."""
    written = work.keep(pairs.distinct())
    mark = F.xxhash64("a", "b").cast("decimal(38,0)")
    row = written.agg(F.count("*"), F.coalesce(F.sum(mark), F.lit(0).cast("decimal(38,0)"))).first()
    return written, (int(row[0]), int(row[1]))


def crc32_fold(doc_id: Column | str) -> Column:
    """The remainder by 4 of the CRC-32 of an id's decimal text; 2 marks the held-out rows."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4, F.lit(0))
