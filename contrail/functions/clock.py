"""Numeric clock values (hhmm) to ``HH:mm`` text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casts import to_number, to_whole


def clock_text(column: Column, kind: str = "string") -> Column:
    """930 becomes ``09:30``; 2400 is midnight; impossible times become NULL.

    Hour and minute text are looked up by number in two small constant lists.
    A number outside its list gives NULL, which makes the range check part of
    the lookup: no text is parsed, matched or padded per row.  A value of five or
    more digits keeps its leading four.
    """
    number = to_number(column, kind)
    if kind == "string":
        number, kind = number.cast("double"), "double"
    hhmm = _leading_digits(number, kind)
    hours = F.array(*(F.lit(f"{hour:02d}:") for hour in range(24)))
    minutes = F.array(*(F.lit(f"{minute:02d}") for minute in range(60)))
    return F.concat(F.get(hours, (hhmm / 100).cast("int")), F.get(minutes, hhmm % 100))


def _leading_digits(number: Column, kind: str) -> Column:
    whole = to_whole(number, kind)
    return (F.when(number == 2400, 0)
            .when(number < 10000, whole)
            .otherwise(F.substring(whole.cast("string"), 1, 4).try_cast("int")))
