"""How much one task takes, whatever the size of the tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Compressed bytes that one task scans or reads from a shuffle; rows in memory take several times that.
SCANNED_BYTES = 16 << 20
SHUFFLED_BYTES = 8 << 20
# Shuffle partitions before adaptive execution puts small ones together, as a multiple of the caller's.
FINER = 4

_SCAN = "spark.sql.files.maxPartitionBytes"
_SHUFFLE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """What runs in here is cut into tasks of bounded size; smaller sizes that the caller set stay.

    Adaptive execution puts partitions together until there is one per core or the advised size, 64 MB, is
    reached. Compressed columns of numbers take many times that in sorts and hash tables, so up to there
    the memory of a task grows with the table. Only actions within the block are planned this way.
    """
    conf = spark.conf
    before = {key: conf.get(key, None) for key in (_SCAN, _SHUFFLE, _FIRST)}
    to_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    finer = FINER * int(conf.get("spark.sql.shuffle.partitions"))
    try:
        conf.set(_SCAN, f"{min(SCANNED_BYTES, to_bytes(conf.get(_SCAN)))}b")
        conf.set(_SHUFFLE, f"{min(SHUFFLED_BYTES, to_bytes(conf.get(_SHUFFLE)))}b")
        conf.set(_FIRST, str(max(finer, int(before[_FIRST] or 0))))
        yield
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)
