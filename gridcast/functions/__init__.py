"""Column expressions (built-in Spark functions only): time, calendar, numeric."""

from .timefns import local_fields, localize_fixed_offset, parse_instant, reformat_timestamp
from .numeric import clip, degree_days, vector_direction
from .calendar import (cyclical_calendar, easter_orthodox, holiday_classes, hour_harmonics,
                       is_weekend)

__all__ = [
    "local_fields", "localize_fixed_offset", "parse_instant", "reformat_timestamp", "clip",
    "degree_days", "vector_direction", "cyclical_calendar", "easter_orthodox", "holiday_classes",
    "hour_harmonics", "is_weekend",
]
