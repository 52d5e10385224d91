"""Trip files: comma-separated, no header, quotes are ordinary characters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from velograph.schemas import TRIP_SCHEMA
from velograph.sources.rejects import malformed_records, read_delimited


def read_trips(spark: SparkSession, path: str, report: Observation | None = None) -> DataFrame:
    """Read a folder of trip files. Fields that do not parse become NULL.

    ``report`` then tells how many lines and fields that were, see ``read_delimited``.
    """
    return read_delimited(spark, path, TRIP_SCHEMA, ",", report)


def malformed_trips(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``read_trips`` could not take whole: ``file, line_number, line, reason``."""
    return malformed_records(spark, path, TRIP_SCHEMA, ",")
