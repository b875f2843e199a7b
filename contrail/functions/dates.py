"""Dates from parts, and the attributes of a calendar day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Three numbers to a date; a missing or impossible part gives NULL.

    ``concat`` is NULL when any part is.  (``concat_ws`` would skip a NULL month
    and read 1987-NULL-5 as the first of May.)
    """
    dash = F.lit("-")
    return F.concat(year, dash, month, dash, day).try_cast("date")


def calendar_attributes(day: Column) -> dict[str, Column]:
    """The thirteen attributes of a calendar day, in table order."""
    year, quarter, month = F.year(day), F.quarter(day), F.month(day)
    quarter_text = F.concat(F.lit("Q"), quarter.cast("string"))
    month_short = F.date_format(day, "MMM")
    return {
        "year": year,
        "quarter": quarter_text,
        "month": month,
        "day": F.dayofmonth(day),
        "dayofweek": F.dayofweek(day),
        "dayofyear": F.dayofyear(day),
        "weekofyear": F.weekofyear(day),
        "month_short": month_short,
        "month_name": F.date_format(day, "MMMM"),
        "month_year": F.concat_ws("-", year, month_short),
        "sort_month_year": year * 100 + month,
        "quarter_year": F.concat_ws("-", year, quarter_text),
        "sort_quarter_year": year * 100 + quarter,
    }
