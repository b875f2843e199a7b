"""Column functions: no DataFrame in, no DataFrame out, built-ins only."""

from .casts import to_flag, to_number, to_whole
from .clock import clock_text
from .dates import calendar_attributes, day_from_parts
from .text import place_parts

__all__ = ["to_flag", "to_number", "to_whole", "clock_text", "calendar_attributes",
           "day_from_parts", "place_parts"]
