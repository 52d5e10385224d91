"""Departures and arrivals per station."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def station_trip_balance(trips: DataFrame, drop_null_station: bool = False) -> DataFrame:
    """Departures and arrivals per station, ordered by station; the missing side counts 0.

    One scan and one shuffle: each trip is turned into its two ends, which are counted together.
    Trips without a start station give one row ``(NULL, 0, 0)`` and trips without a stop station
    another, as joining two separate counts would (see ``station_trip_balance_join``);
    ``drop_null_station`` leaves both out.
    """
    ends = trips.select(
        F.col("start_station_name").alias("departure"), F.col("stop_station_name").alias("arrival")
    ).unpivot([], ["departure", "arrival"], "side", "station")
    if drop_null_station:
        ends = ends.filter(F.col("station").isNotNull())
    named = F.col("station").isNotNull()
    counts = ends.groupBy("station", F.when(~named, F.col("side")).alias("null_side")).agg(
        F.count_if(named & (F.col("side") == "departure")).alias("num_departure_trips"),
        F.count_if(named & (F.col("side") == "arrival")).alias("num_arrival_trips"),
    )
    return counts.drop("null_side").orderBy("station")


def station_trip_balance_join(trips: DataFrame, drop_null_station: bool = False) -> DataFrame:
    """Same result as ``station_trip_balance`` from two counts and a full outer join.

    Scans the trips twice; only the counts, one row per station, meet in the join.
    """
    departures = trips.groupBy(F.col("start_station_name").alias("departure")).agg(
        F.count("start_station_name").alias("num_departure_trips")
    )
    arrivals = trips.groupBy(F.col("stop_station_name").alias("arrival")).agg(
        F.count("stop_station_name").alias("num_arrival_trips")
    )
    balance = (
        departures.join(arrivals, F.col("departure") == F.col("arrival"), "full")
        .select(
            F.coalesce("departure", "arrival").alias("station"),
            "num_departure_trips",
            "num_arrival_trips",
        )
        .na.fill(0, ["num_departure_trips", "num_arrival_trips"])
    )
    if drop_null_station:
        balance = balance.filter(F.col("station").isNotNull())
    return balance.orderBy("station")
