"""I28 master builds: compositions of grid, fill, join and interval operators.

Inputs are long or wide DataFrames keyed by instants; every step is one of the
library's operators, so the master is one lazy plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import row_sum_zero
from ..operators.joins import date_flag, interval_coverage, lookup_default
from ..operators.timegrid import explode_grid, fill_on_grid, grid_bounds, trim

OUTAGE_FLAGS = ["prod_maint", "gen_maint", "gen_outages"]


def supply_master(generation: DataFrame, net: DataFrame, weather: DataFrame, calendar: DataFrame,
                  outages: DataFrame | None, *, types: Sequence[str], weather_cols: Sequence[str],
                  cut: str | None = None, tz: str = "Europe/Sofia") -> DataFrame:
    """Supply master (hourly): Σ generation types (missing = 0) + net position,
    weather, weekend/holiday flags and closed-interval outage flags per business type.

    ``generation``: long ``(type, ts, value)``; ``net``: ``(ts, net_position)``;
    ``weather``: ``(ts, <weather_cols>)``; ``calendar``: days off
    ``(date, is_weekend, is_holiday)``; ``outages``: ``(category, start, end)`` or
    None (absent event set → flags 0). Grid: floor(min)…ceil(max) of generation.
    Generation, net position and weather are forward-filled on the grid.
    """
    b = grid_bounds(generation.withColumn("_s", F.lit(1)), ["_s"], "ts", "1 hour", "floor_ceil")
    grid = explode_grid(b, ["_s"]).drop("_s")
    wide = generation.groupBy("ts").pivot("type", list(types)).agg(F.first("value"))
    m = grid.join(wide, "ts", "left").join(net, "ts", "left").join(weather, "ts", "left")
    m = fill_on_grid(m.withColumn("_one", F.lit(1)), ["_one"], "ts", [*types, "net_position", *weather_cols]).drop("_one")
    m = m.withColumn("supply", row_sum_zero(list(types), plus="net_position"))
    m = m.withColumn("_d", F.to_date(F.from_utc_timestamp("ts", tz)))
    cal = calendar.select(F.col("date").alias("_d"), "is_weekend", "is_holiday")
    m = lookup_default(m, cal.select("_d", "is_weekend"), ["_d"], "is_weekend")
    m = lookup_default(m, cal.select("_d", "is_holiday"), ["_d"], "is_holiday").drop("_d")
    if outages is not None:
        cov = interval_coverage(outages, category="category", closed=True, step_seconds=3600,
                                categories=OUTAGE_FLAGS)
        flags = cov.groupBy("ts").pivot("category", OUTAGE_FLAGS).agg(F.max((F.col("active") > 0).cast("int")))
        m = m.join(flags, "ts", "left")
    for f in OUTAGE_FLAGS:
        m = m.withColumn(f, F.coalesce(F.col(f), F.lit(0)) if f in m.columns else F.lit(0))
    m = trim(m, "ts", cut, ["supply"])
    return m.select("ts", "supply", *types, "net_position", *weather_cols, "is_weekend", "is_holiday", *OUTAGE_FLAGS)


def day_ahead_master(load: DataFrame, forecast: DataFrame, weather: DataFrame, days_off: DataFrame, *,
                     cut: str, weather_cols: Sequence[str], tz: str = "Europe/Sofia") -> DataFrame:
    """Day-ahead master: hourly grid ``[max(cut, first load), last load]``; load,
    operator forecast and weather reindexed onto it; day-off flag by local date;
    rows without load dropped."""
    b = load.agg(F.greatest(F.min("ts"), F.to_timestamp(F.lit(cut))).alias("grid_start"),
                 F.max("ts").alias("grid_end"))
    grid = explode_grid(b, [])
    m = (grid.join(load.select("ts", F.col("load").alias("load_actual_mw")), "ts", "left")
         .join(forecast.select("ts", F.col("forecast").alias("load_forecast_mw")), "ts", "left")
         .join(weather.select("ts", *weather_cols), "ts", "left"))
    m = date_flag(m, F.to_date(F.from_utc_timestamp("ts", tz)), days_off, "is_day_off")
    return trim(m, "ts", cut, ["load_actual_mw"])


def week_ahead_master(load: DataFrame, weather_naive: DataFrame, days_off: DataFrame, *, cut: str,
                      weather_cols: Sequence[str], offset: str = "+03:00", tz: str = "Europe/Sofia") -> DataFrame:
    """Week-ahead master: weather actuals stamped in naive fixed-offset time are
    localised (B2); the grid runs from the latest start to the earliest end of the
    inputs (common grid); rows without load dropped."""
    w = weather_naive.withColumn("ts", F.to_utc_timestamp("ts", offset))
    b = (load.agg(F.min("ts").alias("s1"), F.max("ts").alias("e1"))
         .crossJoin(w.agg(F.min("ts").alias("s2"), F.max("ts").alias("e2")))  # two one-row summaries
         .select(F.greatest("s1", "s2").alias("grid_start"), F.least("e1", "e2").alias("grid_end")))
    grid = explode_grid(b, [])
    m = (grid.join(load.select("ts", F.col("load").alias("load_actual_mw")), "ts", "left")
         .join(w.select("ts", *weather_cols), "ts", "left"))
    m = date_flag(m, F.to_date(F.from_utc_timestamp("ts", tz)), days_off, "is_day_off")
    return trim(m, "ts", cut, ["load_actual_mw"])
