"""Instants, fixed offsets, local wall-clock fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_TZ = "Europe/Sofia"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_instant(text) -> Column:
    """B1: timestamp text with any UTC offset (``+02:00``, ``+03:00`` …) → one instant."""
    return F.to_timestamp(_c(text))


def localize_fixed_offset(naive, offset: str = "+03:00") -> Column:
    """B2: naive wall time at a fixed offset (no DST) → instant."""
    return F.to_utc_timestamp(_c(naive), offset)


def reformat_timestamp(text, fmt: str = "yyyy-MM-dd'T'HH:mm") -> Column:
    """``2024-02-17T05:00`` style text → instant."""
    return F.to_timestamp(_c(text), fmt)


def local_fields(ts, tz: str = LOCAL_TZ, prefix: str = "") -> dict[str, Column]:
    """Wall-clock fields of an instant in ``tz``.

    ``dow`` is Monday = 0 (``weekday``), unlike ``dayofweek`` (Sunday = 1).
    The local timestamp is ambiguous on the autumn DST day, so it is a *field*,
    never a key.
    """
    loc = F.from_utc_timestamp(_c(ts), tz)
    return {
        f"{prefix}local_ts": loc,
        f"{prefix}hour": F.hour(loc),
        f"{prefix}dow": F.weekday(loc),
        f"{prefix}doy": F.dayofyear(loc),
        f"{prefix}month": F.month(loc),
        f"{prefix}day": F.dayofmonth(loc),
        f"{prefix}local_date": F.to_date(loc),
    }
