"""Result listings: text with one result row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velograph.functions.text import rank_line, row_line

# Columns that put the lines of a listing in file order.
LINE_ORDER = ["folder", "part", "file", "block_start", "line_id"]


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a listing, with columns that give their order.

    Row ids grow within a split but splits are handed out largest first, so the file and the
    split's start come before the id. Part files follow their number, as a number, and other files
    their name.
    """
    place = F.col("_metadata.file_path")
    name = F.substring_index(place, "/", -1)
    return spark.read.text(path).select(
        F.substring(place, F.lit(1), F.length(place) - F.length(name)).alias("folder"),
        F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("bigint").alias("part"),
        name.alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
        F.col("value").alias("line"),
    )


def row_listing(df: DataFrame) -> DataFrame:
    """One ``line`` per row of ``df``, as a printed row, in the order of ``df``."""
    return df.select(row_line(df).alias("line"))


def rank_listing_lines(ranks: DataFrame) -> DataFrame:
    """One ``line`` per row of ``(id, pagerank)``, in the order of ``ranks``."""
    return ranks.select(rank_line(F.col("id"), F.col("pagerank")).alias("line"))


def write_listing(lines: DataFrame, path: str) -> None:
    """Write the ``line`` column as text; part files follow the order of ``lines``."""
    lines.select("line").write.text(path)
