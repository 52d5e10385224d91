"""Edge files: ``source target weight`` with one space between the fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from velograph.functions.text import LINE_EDGE_SPACE
from velograph.schemas import EDGE_SCHEMA
from velograph.sources.rejects import malformed_records, numbered_rejects, read_delimited


def read_edges(spark: SparkSession, path: str, report: Observation | None = None) -> DataFrame:
    """Read a folder of edge files. Fields that do not parse become NULL.

    ``report`` then tells how many lines and fields that were, see ``read_delimited``.
    """
    return read_delimited(spark, path, EDGE_SCHEMA, " ", report)


def malformed_edges(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_edges`` could not take whole: ``file, line_number, line, reason``."""
    return malformed_records(spark, path, EDGE_SCHEMA, " ")


def _fields(line: str) -> Column:
    return F.split(F.btrim(line, F.lit(LINE_EDGE_SPACE)), " ", -1)


def _no_node(field: Column) -> Column:
    return field.try_cast("bigint").isNull()


def _fault(fields: Column) -> Column:
    """What keeps a line from being an edge, NULL where nothing does."""
    no_node = _no_node(F.get(fields, 0)) | _no_node(F.get(fields, 1))
    return F.when(F.size(fields) != 3, "expected 3 fields").when(no_node, "no integer node")


def read_edges_strict(spark: SparkSession, path: str) -> DataFrame:
    """Read a folder of edge files in which every line has exactly three fields.

    A line with another number of fields, a blank line included, or with a node that is not an
    integer fails the query; the error names the file, where the split with the line begins in it,
    and the line. ``rejected_edges`` lists all such lines. White space around a line is ignored. The
    weight is not checked and is NULL where it is no integer, since the rank operators do not use it.
    """
    fields = _fields("value")
    place = F.concat(F.col("_metadata.file_path"), F.lit(", from byte "), F.col("_metadata.file_block_start"))
    checked = F.when(
        _fault(fields).isNull(), fields
    ).otherwise(
        F.raise_error(F.concat(_fault(fields), F.lit(" in edge line: "), F.col("value"), F.lit(" ("), place, F.lit(")")))
    )
    return spark.read.text(path).select(
        checked[0].try_cast("bigint").alias("source"),
        checked[1].try_cast("bigint").alias("target"),
        checked[2].try_cast("int").alias("weight"),
    )


def rejected_edges(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_edges_strict`` refuses: ``file, line_number, line, reason``."""
    return numbered_rejects(spark, path, _fault(_fields("value")))
