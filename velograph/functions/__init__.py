"""Column expressions shared by the operators."""

from velograph.functions.numbers import round_exact
from velograph.functions.text import decimal_text, rank_line, row_line, squeeze

__all__ = ["decimal_text", "rank_line", "round_exact", "row_line", "squeeze"]
