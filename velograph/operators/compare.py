"""Comparison of a result with the expected one.

Every function returns one row ``left_rows, right_rows, differing_rows, passed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from velograph.functions import squeeze
from velograph.layout import number_runs, small_tasks
from velograph.sources.listings import LINE_ORDER

# Positions that are compared in one go.
_STRETCH = 1 << 16
# Types whose values are equal exactly when their texts are, and whose texts have no white space.
_PLAIN = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType)


def diff_listings(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare two listings (``read_listing``) line by line, white space ignored.

    Blank lines count as lines.
    """
    return diff_by_position(expected, actual, LINE_ORDER, ["line"])


def diff_by_position(
    expected: DataFrame, actual: DataFrame, order_by: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Compare ``columns`` of the n-th row of one side with the n-th row of the other.

    ``order_by`` has to order the rows of a side completely; rows that it does not tell apart are taken
    in the order of their values. White space within the values is ignored. A row without partner differs.

    Equal rows are one run with a number of copies, and each side is written once, as its runs. Runs are
    cut at fixed positions, and the two sides of each stretch of positions meet in one task, which steps
    from one run's start to the next: a run of many copies is compared as a whole.

    Values of a type that both sides share stay as they are where their texts say no more. The comparison
    runs at once, in tasks whose size does not follow that of the sides.
    """
    with small_tasks(expected.sparkSession):
        return _counted(_by_position(expected, actual, order_by, columns))


def _by_position(
    expected: DataFrame, actual: DataFrame, order_by: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    left, right = expected.select(*columns).schema, actual.select(*columns).schema
    plain = {c for c, x, y in zip(columns, left, right, strict=True) if x.dataType == y.dataType and isinstance(x.dataType, _PLAIN)}
    # The columns under names of their own; a plain value that is ordered by is kept once.
    order = {c: f"_order{i}" for i, c in enumerate(order_by)}
    shown = {c: order[c] if c in plain and c in order else f"_shown{i}" for i, c in enumerate(columns)}
    ties = [F.col(name).cast("string") for name in shown.values() if name not in order.values()]

    def cut(df: DataFrame, side: int) -> DataFrame:
        values = [(F.col(c) if c in plain else _value(c)).alias(name) for c, name in shown.items() if name not in order.values()]
        rows = df.select(*[F.col(c).alias(name) for c, name in order.items()], *values)
        runs = number_runs(rows, list(order.values()), list(shown.values()), ties)
        last = F.col("first") + F.col("copies") - 1
        blocks = F.sequence(F.expr(f"first div {_STRETCH}"), F.floor(last / _STRETCH).cast("bigint"))
        start = F.greatest("first", F.col("block") * _STRETCH)
        end = F.least(last + 1, (F.col("block") + 1) * _STRETCH)
        return runs.withColumn("block", F.explode(blocks)).select(
            "block", start.alias("start"), end.alias("end"), F.struct(*shown.values()).alias("values"), F.lit(side).alias("side")
        )

    met = cut(expected, 0).unionByName(cut(actual, 1))
    in_order = Window.partitionBy("block").orderBy("start", "side")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.struct("values", "end")
    steps = met.select(
        "*",
        F.last(F.when(F.col("side") == 0, run), ignorenulls=True).over(so_far).alias("left"),
        F.last(F.when(F.col("side") == 1, run), ignorenulls=True).over(so_far).alias("right"),
        F.coalesce(F.lead("start").over(in_order), (F.col("block") + 1) * _STRETCH).alias("until"),
    )

    def reach(side: str) -> Column:
        """Positions that the side has from here to the next step."""
        return F.greatest(F.least(F.coalesce(F.col(f"{side}.end"), F.lit(0)), F.col("until")) - F.col("start"), F.lit(0))

    both, either = F.least(reach("left"), reach("right")), F.greatest(reach("left"), reach("right"))
    same = F.col("left.values").eqNullSafe(F.col("right.values"))
    return _verdict(
        steps,
        F.sum(F.when(F.col("side") == 0, F.col("end") - F.col("start"))),
        F.sum(F.when(F.col("side") == 1, F.col("end") - F.col("start"))),
        F.sum(either - F.when(same, both).otherwise(F.lit(0))),
    )


def diff_by_key(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Compare rows with equal ``keys``, which have to be unique on each side and may be NULL.

    Values are compared as they are; both sides must have the same columns and types.
    """
    _check_same_columns(expected, actual)
    columns = [c for c in expected.columns if c not in keys]

    def keyed(df: DataFrame, side: str) -> DataFrame:
        return df.select(
            *[F.col(k).alias(f"{side}_{k}") for k in keys],
            F.struct(F.lit(True).alias("_"), *columns).alias(f"{side}_values"),
        )

    left, right = keyed(expected, "left"), keyed(actual, "right")
    match = F.lit(True)
    for k in keys:
        match = match & left[f"left_{k}"].eqNullSafe(right[f"right_{k}"])
    return _summary(left.join(right, match, "full"))


def diff_as_multiset(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Compare the sides as bags of whole rows, in any order.

    ``differing_rows`` counts the rows that ``exceptAll`` would leave in either direction. Equal
    rows are combined before the shuffle, however many there are. Both sides must have the same
    columns and types. The comparison runs at once, in tasks whose size does not follow that of the sides.
    """
    _check_same_columns(expected, actual)
    with small_tasks(expected.sparkSession):
        return _counted(_as_multiset(expected, actual))


def _as_multiset(expected: DataFrame, actual: DataFrame) -> DataFrame:
    columns = expected.columns
    signed = expected.withColumn("_copies", F.lit(1)).unionByName(
        actual.select(*columns).withColumn("_copies", F.lit(-1))
    )
    surplus = signed.groupBy(*columns).agg(
        F.count_if(F.col("_copies") > 0).alias("left_copies"),
        F.count_if(F.col("_copies") < 0).alias("right_copies"),
    )
    return _verdict(
        surplus,
        F.sum("left_copies"),
        F.sum("right_copies"),
        F.sum(F.abs(F.col("left_copies") - F.col("right_copies"))),
    )


def _check_same_columns(expected: DataFrame, actual: DataFrame) -> None:
    left, right = sorted(expected.dtypes), sorted(actual.dtypes)
    if left != right:
        raise ValueError(f"the columns differ: {left} and {right}")


def _value(column: str) -> Column:
    """A compared value as text, without white space."""
    return squeeze(F.col(column).cast("string"))


def _counted(verdict: DataFrame) -> DataFrame:
    """The one row of counts, made now."""
    return verdict.sparkSession.createDataFrame([tuple(verdict.first())], verdict.schema)


def _summary(pairs: DataFrame) -> DataFrame:
    # The value columns are never NULL themselves, so a NULL means that the side has no such row.
    return _verdict(
        pairs,
        F.count("left_values"),
        F.count("right_values"),
        F.count_if(~F.col("left_values").eqNullSafe(F.col("right_values"))),
    )


def _verdict(rows: DataFrame, left: Column, right: Column, differing: Column) -> DataFrame:
    return rows.agg(
        F.coalesce(left, F.lit(0)).alias("left_rows"),
        F.coalesce(right, F.lit(0)).alias("right_rows"),
        F.coalesce(differing, F.lit(0)).alias("differing_rows"),
    ).withColumn("passed", F.col("differing_rows") == 0)
