"""The daily summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contracts as C


def daily_summary(silver: DataFrame) -> DataFrame:
    """One row per day (a NULL day is a day of its own), 29 measures.

    Rows are reduced on the map side to one row per (day, carrier), so a day
    holding a third of all flights costs its shuffle no more than any other.

    Each mean is a quotient of two sums that the count and total measures need
    as well: a delay family keeps two or three aggregate buffers instead of
    five, which narrows both the hash rows and the shuffled rows.
    """
    return _measures(silver.groupBy("date").agg(
        F.count_distinct("UniqueCarrier").alias("num_carriers"), *_buffers()))


def daily_state(silver: DataFrame) -> DataFrame:
    """What the daily summary needs of a lot of flights: its sums by day and carrier.

    States of several lots add up: see ``summary_of_state``.
    """
    return silver.groupBy("date", "UniqueCarrier").agg(*_buffers())


def summary_of_state(state: DataFrame) -> DataFrame:
    """The daily summary of all flights whose states are given, in any number of rows."""
    sums = [name for name in state.columns if name not in ("date", "UniqueCarrier")]
    return _measures(state.groupBy("date").agg(
        F.count_distinct("UniqueCarrier").alias("num_carriers"),
        *(F.sum(name).alias(name) for name in sums)))


def _buffers() -> list[Column]:
    return [
        F.sum(F.col("Cancelled").cast("int")).alias("total_cancelled"),
        F.sum(F.col("Diverted").cast("int")).alias("total_diverted"),
        F.sum("AirTime").alias("total_air_time"),
        F.count("AirTime").alias("known_air_time"),
        *(buffer for family in C.DELAY_FAMILIES for buffer in _delay_buffers(family)),
        F.sum("Distance").alias("total_distance"),
        F.count("Distance").alias("known_distance"),
        F.count(F.lit(1)).alias("num_flights"),
    ]


def _measures(sums: DataFrame) -> DataFrame:
    return sums.select(
        "date",
        "num_carriers",
        "total_cancelled",
        "total_diverted",
        _mean("total_air_time", "known_air_time").alias("avg_air_time"),
        "total_air_time",
        *(measure for family in C.DELAY_FAMILIES for measure in _delay_measures(family)),
        "total_distance",
        _mean("total_distance", "known_distance").alias("average_distance"),
        "num_flights",
    )


def _delay_buffers(family: str) -> list[Column]:
    column, clipped = C.DELAY_FAMILIES[family]
    delay = F.col(column)
    late = F.when(delay > 0, delay)
    buffers = [F.count(late).alias(f"count_{family}_delay"),
               F.sum(late).alias(f"late_{family}")]
    if not clipped:
        buffers.append(F.sum(delay).alias(f"all_{family}"))
    return buffers


def _delay_measures(family: str) -> list[Column]:
    _, clipped = C.DELAY_FAMILIES[family]
    count, late = f"count_{family}_delay", f"late_{family}"
    total = late if clipped else f"all_{family}"
    return [
        F.col(count),
        F.coalesce(F.col(total), F.lit(0)).cast("bigint").alias(f"total_{family}_delay"),
        _mean(late, count).alias(f"average_{family}_delay"),
    ]


def _mean(total: str, count: str) -> Column:
    """Mean to two places; NULL where nothing was counted."""
    return F.round(F.col(total) / F.nullif(F.col(count), F.lit(0)), 2)
