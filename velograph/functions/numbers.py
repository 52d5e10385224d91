"""Rounding of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2^27 + 1 splits a double into two halves whose products are exact (Dekker 1971).
_SPLITTER = 134217729.0
# Doubles from 2^52 on are whole numbers.
_WHOLE = float(2**52)


def round_exact(value: Column, places: int = 2) -> Column:
    """Round a double to ``places`` by its exact binary value, exact halves going to even.

    Spark's ``round`` and ``bround`` look at the shortest decimal text, so 2.675, which is stored
    a little below 2.675, becomes 2.68 there and 2.67 here. The scaled value is kept as an
    unevaluated sum ``scaled + error`` (Dekker's product), which decides on which side of the half
    the value lies. A value without digits beyond ``places``, being so large, infinite or no number,
    is its own result.
    """
    power = 10.0**places
    high = value * _SPLITTER - (value * _SPLITTER - value)
    scaled = value * power
    error = (high * power - scaled) + (value - high) * power
    # rint stays a double, where floor gives a BIGINT; it is at most a half away from the floor.
    nearby = F.rint(scaled)
    below = F.when(nearby > scaled, nearby - 1.0).otherwise(nearby)
    past_half = ((scaled - below) - 0.5) + error
    even = below + F.pmod(below, F.lit(2.0))
    nearest = F.when(past_half > 0, below + 1.0).when(past_half < 0, below).otherwise(even)
    return F.when(F.isnan(value) | (F.abs(scaled) >= _WHOLE), value).otherwise(nearest / power)
