"""Named queries over the parquet tables, and the SQL that each must agree with."""

from velograph.plans.oracle import ORACLE_SQL
from velograph.plans.registry import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
