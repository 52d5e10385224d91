"""Operators for preparing training text at scale, and the named queries over them."""

from velograph.llm.queries import ORACLE_SQLS, QUERIES

__all__ = ["ORACLE_SQLS", "QUERIES"]
