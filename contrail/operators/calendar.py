"""The generated calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_attributes


def date_range(frame: DataFrame, column: str = "date") -> DataFrame:
    """First and last day as one row; both NULL when there is no day."""
    return frame.agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))


def calendar_for(frame: DataFrame, column: str = "date") -> DataFrame:
    """Every day of every year from the first to the last seen in ``column``.

    The range stays a one-row relation: nothing comes back to the driver.  Days
    are generated a year at a time, so no array is longer than 366.
    """
    years = date_range(frame, column).select(
        F.explode(F.sequence(F.year("min_date"), F.year("max_date"))).alias("y"))
    days = years.select(
        F.explode(F.sequence(F.make_date("y", F.lit(1), F.lit(1)),
                             F.make_date("y", F.lit(12), F.lit(31)))).alias("dte"))
    return days.select("dte", *(attribute.alias(name) for name, attribute
                                in calendar_attributes(F.col("dte")).items()))
