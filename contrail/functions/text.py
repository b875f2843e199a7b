"""Text splitting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def place_parts(description: Column) -> dict[str, Column]:
    """``"city, country: name"`` to its three parts; a missing part is NULL."""
    pieces = F.split(description, ", ")
    place = F.split(F.get(pieces, F.lit(1)), ": ")
    return {
        "airport_name": F.get(place, F.lit(1)),
        "city": F.get(pieces, F.lit(0)),
        "country": F.get(place, F.lit(0)),
    }
