"""Tolerant casts: unreadable text becomes NULL whether or not ANSI is on.

``kind`` is the type the column has now.  Knowing it keeps needless conversions
out of the generated code, whose size decides whether the JVM compiles it: see
``operators.cleaning``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Unlike double, decimal reads neither ``NaN`` nor a type suffix as in ``14d``.
_TEXT_NUMBER = "decimal(20,6)"

# Texts that a cast may read.  One that it cannot costs it an exception, dearer than
# all else done with a row; the cast still decides about those that match.
_MAY_BE_NUMBER = (r"^[\x00-\x20]*[+-]?(\p{Nd}+\.?\p{Nd}*|\.\p{Nd}+)([eE][+-]?\p{Nd}+)?"
                  r"[\x00-\x20]*$")
_MAY_BE_FLAG = r"^[\x00-\x20\x7F]*(?i:t|true|y|yes|1|f|false|n|no|0)[\x00-\x20\x7F]*$"


def to_number(column: Column, kind: str = "string", odd: bool = False) -> Column:
    """Numeric text to decimal; numbers stay as they are.

    ``odd`` expects many texts that are no numbers and tells them by a pattern, at the
    price of a search a text and of code; otherwise the cast alone does.
    """
    if kind != "string":
        return column
    text = F.when(column.rlike(_MAY_BE_NUMBER), column) if odd else column
    return text.try_cast(_TEXT_NUMBER)


def to_whole(column: Column, kind: str = "string", odd: bool = False) -> Column:
    """Number or numeric text to int, cut towards zero: ``'14.9'`` gives 14."""
    return column if kind == "int" else to_number(column, kind, odd).try_cast("int")


def to_flag(column: Column, kind: str = "string", odd: bool = False) -> Column:
    """``0`` / ``1`` in any numeric spelling (``1``, ``1.00``) or a boolean word to
    boolean; a number that is not one (NaN) is NULL."""
    if kind == "boolean":
        return column
    if kind == "string":
        word = F.when(column.rlike(_MAY_BE_FLAG), column) if odd else column
        return F.coalesce(to_number(column, kind, odd) != 0, word.try_cast("boolean"))
    if kind in ("float", "double"):
        return F.nanvl(column, F.lit(None).cast(kind)) != 0
    return column != 0
