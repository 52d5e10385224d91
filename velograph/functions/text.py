"""Text forms used by result listings and their comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters stripped from both ends of a listing line, and the listing formats.
LINE_EDGE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0" + (
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
RANK_ID_LABEL = "id="
RANK_VALUE_LABEL = "; pagerank="


def squeeze(text: Column) -> Column:
    """Strip outer white space, then remove every inner space."""
    return F.replace(F.btrim(text, F.lit(LINE_EDGE_SPACE)), F.lit(" "), F.lit(""))


def decimal_text(value: Column) -> Column:
    """Text of a double with at most two decimals, in plain digits: 1.2, 1.0, 12345678.25."""
    return F.regexp_replace(value.cast("decimal(38,2)").cast("string"), "0$", "")


def rank_line(node: Column, rank: Column) -> Column:
    """Listing line of one ranked node: ``id=6; pagerank=1.69``."""
    return F.concat(
        F.lit(RANK_ID_LABEL), node.cast("string"), F.lit(RANK_VALUE_LABEL), decimal_text(rank)
    )


def _quoted(text: Column) -> Column:
    """Quoted text as in a printed row: single quotes unless only double quotes avoid escapes."""
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    double = text.contains("'") & ~text.contains('"')
    return F.when(double, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'"))
    )


def row_line(df: DataFrame) -> Column:
    """Listing line of one row of ``df``: ``Row(id=1, cost=0, path='1')``.

    Covers the result types of this package: integers, strings and booleans.
    """
    fields = []
    for field in df.schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            text = _quoted(value)
        elif isinstance(field.dataType, T.BooleanType):
            text = F.initcap(value.cast("string"))
        elif isinstance(field.dataType, T.IntegralType):
            text = value.cast("string")
        else:
            raise TypeError(f"no row text for {field.name}: {field.dataType.simpleString()}")
        fields.append(F.concat(F.lit(field.name + "="), F.coalesce(text, F.lit("None"))))
    return F.concat(F.lit("Row("), F.concat_ws(", ", *fields), F.lit(")"))
