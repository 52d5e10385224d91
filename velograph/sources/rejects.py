"""What the readers could not take: counts on the way, and the lines themselves on request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_RECORD = "_malformed"


def read_delimited(spark: SparkSession, path: str, schema: str, separator: str, report: Observation | None) -> DataFrame:
    """Delimited text whose fields become NULL where they do not parse.

    With ``report``, the first action on the result also counts the lines, those with a field that did
    not parse or with another number of fields as ``malformed_lines``, and each column's NULL fields
    as ``null_<column>``. That reads all columns; without a report only those in use are.
    """
    reader = spark.read.options(sep=separator, quote="", header=False)
    if report is None:
        return reader.schema(schema).csv(path)
    lines = reader.schema(f"{schema}, {_RECORD} STRING").option("columnNameOfCorruptRecord", _RECORD).csv(path)
    columns = [c for c in lines.columns if c != _RECORD]
    counted = lines.observe(
        report,
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col(_RECORD).isNotNull()).alias("malformed_lines"),
        *(F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns),
    )
    return counted.select(*columns)


def malformed_records(spark: SparkSession, path: str, schema: str, separator: str) -> DataFrame:
    """The lines of which ``read_delimited`` made a field NULL: ``file, line_number, line, reason``."""
    options = {"sep": separator, "quote": "", "columnNameOfCorruptRecord": _RECORD}
    record = F.from_csv("value", f"{schema}, {_RECORD} STRING", options)[_RECORD]
    # Blank lines are no records.
    reason = F.when((F.trim("value") != "") & record.isNotNull(), F.lit("a field that does not parse, or is missing or too many"))
    return numbered_rejects(spark, path, reason)


def numbered_rejects(spark: SparkSession, path: str, reason: Column) -> DataFrame:
    """The lines of text files for which ``reason``, of the column ``value``, is not NULL.

    Columns ``file, line_number, line, reason``; numbers count from 1 in each file. A split knows only
    the places of its own lines, so a table with one row per split says how many come before. No line
    is shuffled but the rejected ones.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    splits = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    earlier = F.expr("coalesce(sum(n) OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    splits = splits.select("file", "block", "first", earlier.alias("before"))
    rejected = lines.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return rejected.join(splits, ["file", "block"]).select(
        "file", (F.col("id") - F.col("first") + F.col("before") + 1).alias("line_number"), F.col("value").alias("line"), "reason"
    )
