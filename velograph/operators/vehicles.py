"""Use of vehicles, and moves of a vehicle between two trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velograph.layout import (
    ROW_ID,
    ROWS_PER_TASK,
    cut_lineage,
    heavy_keys,
    with_row_ids,
)


def top_n_vehicles(trips: DataFrame, top_n: int) -> DataFrame:
    """The ``top_n`` vehicles by total trip time, with their number of trips.

    Equal totals are ordered by vehicle id.
    """
    return (
        trips.groupBy("bike_id")
        .agg(F.sum("trip_duration").alias("totalTime"), F.count("trip_id").alias("numTrips"))
        .orderBy(F.desc("totalTime"), "bike_id")
        .limit(top_n)
    )


def relocation_flags(
    trips: DataFrame,
    tie_break: Sequence[str] = ("trip_id",),
    rows_per_task: int = ROWS_PER_TASK,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``moved_from_station`` and ``moved_from_time`` to every trip.

    They tell where and since when the vehicle stood before it was moved to the start of the trip,
    and are NULL when it was not moved. The arguments are those of ``vehicle_relocations``. Trips
    of an unknown vehicle follow no other trip.
    """
    counted = trips if count_from is None else count_from
    return _flag(trips, counted, _time_order(tie_break), rows_per_task)


def vehicle_relocations(
    trips: DataFrame,
    bike_id: int | None = None,
    tie_break: Sequence[str] = ("trip_id",),
    rows_per_task: int = ROWS_PER_TASK,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Moves of a vehicle between two trips, ordered by the time the move starts.

    A move runs from the stop of one trip to the start of the vehicle's next trip when the two
    stations differ. With ``bike_id`` only that vehicle is read, otherwise all are and the result
    also has the column ``bike_id``. Trips of a vehicle are ordered by start time, stop time,
    ``tie_break`` and at last the station names, so the result does not depend on the input order.

    A vehicle with more than ``rows_per_task`` trips is not handled in one task, see
    ``_split_by_time``. Such vehicles are found by counting ``trips``, or ``count_from`` where
    another table has the same ``bike_id`` values and is cheaper to read.
    """
    order = _time_order(tie_break)
    wanted = F.col("bike_id").isNotNull() if bike_id is None else F.col("bike_id") == bike_id
    rides = trips.filter(wanted).select("bike_id", *order)
    counted = rides if count_from is None else count_from.filter(wanted)
    moves = (
        _flag(rides, counted, order, rows_per_task)
        .filter(F.col("moved_from_station").isNotNull())
        .select(
            "bike_id",
            F.col("moved_from_time").alias("start_time"),
            F.col("moved_from_station").alias("start_station_name"),
            F.col("start_time").alias("stop_time"),
            F.col("start_station_name").alias("stop_station_name"),
        )
        # A global sort reads its input twice, first to find its ranges. Shuffled rows are simply
        # read again, where the window, the costliest stage, would run again.
        .repartition("start_time", "stop_time", "bike_id")
        .orderBy("start_time", "stop_time", "start_station_name", "stop_station_name", "bike_id")
    )
    return moves if bike_id is None else moves.drop("bike_id")


def _time_order(tie_break: Sequence[str]) -> list[str]:
    return ["start_time", "stop_time", *tie_break, "start_station_name", "stop_station_name"]


def _flag(rides: DataFrame, counted: DataFrame, order: list[str], rows_per_task: int) -> DataFrame:
    """Rides with their relocation flags; the histories of hot vehicles, and no others, are cut into pieces."""
    heavy = heavy_keys(counted, "bike_id", rows_per_task)
    if not heavy:
        return _look_back(rides, [], order)
    hot = heavy.for_join("bike_id")
    # Twice as many pieces as would just do: the ranges are estimated from a sample.
    n_pieces = -(-2 * heavy.heavy_rows // rows_per_task)
    pieces = _split_by_time(rides.join(hot, "bike_id", "left_semi"), order, n_pieces)
    cut = _look_back(pieces, ["chunk"], [F.desc("handed_on"), *order]).filter(~F.col("handed_on"))
    # A ride of an unknown vehicle matches no hot one and stays here.
    return _look_back(rides.join(hot, "bike_id", "left_anti"), [], order).unionByName(cut.drop("chunk", "handed_on"))


def _look_back(rides: DataFrame, groups: list[str], order: list[str | Column]) -> DataFrame:
    """Relocation flags from the ride before, within each vehicle and group.

    Rides of an unknown vehicle follow no other; a hash spreads them over groups of their own.
    """
    known = F.col("bike_id").isNotNull()
    times = [c for c in order if isinstance(c, str)]
    unknown_key = F.when(~known, F.xxhash64(*times))
    by_time = Window.partitionBy("bike_id", unknown_key, *groups).orderBy(*order)
    # The lags are columns first, so that each is computed once and not per use.
    before = rides.withColumns(
        {
            "moved_from_station": F.lag("stop_station_name").over(by_time),
            "moved_from_time": F.lag("stop_time").over(by_time),
        }
    )
    moved = known & (F.col("moved_from_station") != F.col("start_station_name"))
    return before.withColumns(
        {
            "moved_from_station": F.when(moved, F.col("moved_from_station")),
            "moved_from_time": F.when(moved, F.col("moved_from_time")),
        }
    )


def _split_by_time(rides: DataFrame, order: list[str], n_pieces: int) -> DataFrame:
    """Rides with a column ``chunk`` that cuts vehicles' histories into ``n_pieces`` pieces or so.

    A range partitioning on vehicle and time gives the pieces. It is written once, so every reader
    sees the same cuts. The last ride before a piece is repeated at its head, marked
    ``handed_on``, to let the first ride of the piece look back.
    """
    placed = cut_lineage(
        with_row_ids(rides)
        .repartitionByRange(n_pieces, "bike_id", *order, ROW_ID)
        .drop(ROW_ID)
        .withColumn("chunk", F.spark_partition_id())
    )
    # One row per vehicle and piece, so no more rows than pieces plus vehicles.
    last_rides = placed.filter(F.col("bike_id").isNotNull()).groupBy("bike_id", "chunk").agg(F.max(F.struct(*order)).alias("last"))
    by_chunk = Window.partitionBy("bike_id").orderBy("chunk")
    heads = (
        last_rides.withColumn("chunk_after", F.lead("chunk").over(by_chunk))
        .filter(F.col("chunk_after").isNotNull())
        .select("bike_id", "last.*", F.col("chunk_after").alias("chunk"), F.lit(True).alias("handed_on"))
    )
    return placed.withColumn("handed_on", F.lit(False)).unionByName(heads, allowMissingColumns=True)
