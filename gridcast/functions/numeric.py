"""H3, H9, H11, D3/D4 helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lower=None, upper=None) -> Column:
    """H9: pandas ``clip`` — NULL stays NULL (Spark ``greatest`` would skip it)."""
    x = _c(c)
    y = x
    if lower is not None:
        y = F.greatest(y, F.lit(lower))
    if upper is not None:
        y = F.least(y, F.lit(upper))
    return F.when(x.isNotNull(), y)


def degree_days(temp, heat_base: float = 18.0, cool_base: float = 22.0) -> dict[str, Column]:
    """H3: heating/cooling degrees and the square, NULL-preserving."""
    t = _c(temp)
    return {"hdd": clip(F.lit(heat_base) - t, lower=0.0), "cdd": clip(t - F.lit(cool_base), lower=0.0),
            "t_sq": F.pow(t, 2)}


def vector_direction(sum_sin: Column, sum_cos: Column) -> Column:
    """``degrees(atan2(Σ s·sinθ, Σ s·cosθ)) mod 360``."""
    return F.pmod(F.degrees(F.atan2(sum_sin, sum_cos)), F.lit(360.0))
