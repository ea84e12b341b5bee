"""Grids, DST days, dedupe, interval semantics, calendar, as-of."""

import datetime as dt

from pyspark.sql import functions as F

from gridcast.functions.calendar import days_off, easter_orthodox, holiday_calendar
from gridcast.operators.joins import asof_year, interval_coverage
from gridcast.operators.timegrid import dedupe, dst_audit, explode_grid


def test_dst_days_have_23_and_25_hours(spark):
    b = spark.createDataFrame([(dt.datetime(2025, 3, 29, 22), dt.datetime(2025, 10, 27, 21))],
                              "grid_start timestamp, grid_end timestamp")
    out = {str(r.local_date): r.hours for r in dst_audit(explode_grid(b, []), "ts").collect()}
    assert out == {"2025-03-30": 23, "2025-10-26": 25}


def test_dedupe_keep_first_and_last(spark):
    t = dt.datetime(2025, 1, 1)
    df = spark.createDataFrame([("a", t, 1.0, 0), ("a", t, 2.0, 1), ("a", t, 3.0, 2)],
                               "s string, ts timestamp, v double, seq int")
    assert dedupe(df, ["s", "ts"], "seq", "first").first().v == 1.0
    assert dedupe(df, ["s", "ts"], "seq", "last").first().v == 3.0


def _iv(spark):
    h = dt.datetime(2025, 1, 1)
    rows = [("x", h + dt.timedelta(minutes=30), h + dt.timedelta(hours=2), 10.0),   # starts mid-hour, ends on 02:00
            ("x", h + dt.timedelta(hours=1), h + dt.timedelta(hours=3), 5.0),      # overlaps
            ("x", None, h + dt.timedelta(hours=3), 99.0),                         # NULL bound: skipped
            ("x", h + dt.timedelta(hours=4), h + dt.timedelta(hours=3), 99.0),    # end before start: skipped
            ("zz", h, h + dt.timedelta(hours=5), 99.0)]                           # unknown type
    return spark.createDataFrame(rows, "category string, start timestamp, end timestamp, mw double")


def test_interval_closed_vs_half_open(spark):
    iv = _iv(spark)
    closed = {r.ts.hour: r.active for r in interval_coverage(
        iv, "2025-01-01 00:00:00", "2025-01-01 04:00:00", categories=["x"]).collect()}
    half = {r.ts.hour: (r.active, r.total) for r in interval_coverage(
        iv, "2025-01-01 00:00:00", "2025-01-01 04:00:00", categories=["x"], value="mw", closed=False).collect()}
    assert closed == {0: 0, 1: 2, 2: 2, 3: 1, 4: 0}
    assert half == {0: (0, 0.0), 1: (2, 15.0), 2: (1, 5.0), 3: (0, 0.0), 4: (0, 0.0)}


def test_orthodox_easter(spark):
    years = spark.createDataFrame([(y,) for y in range(2022, 2028)], "y int")
    got = {r.y: str(r.e) for r in years.select("y", easter_orthodox(F.col("y")).alias("e")).collect()}
    assert got == {2022: "2022-04-24", 2023: "2023-04-16", 2024: "2024-05-05", 2025: "2025-04-20",
                   2026: "2026-04-12", 2027: "2027-05-02"}


def test_substitute_days_off(spark):
    years = spark.createDataFrame([(2022,)], "year int")
    dates = {str(r.date) for r in holiday_calendar(spark, years).collect()}
    assert {"2022-01-03", "2022-12-27", "2022-12-28"} <= dates
    off = days_off(spark, "2022-12-23", "2022-12-30")
    got = {str(r.date): (r.is_weekend, r.is_holiday) for r in off.collect()}
    assert got["2022-12-24"] == (1, 1) and got["2022-12-27"] == (0, 1) and "2022-12-29" not in got


def test_asof_year_gaps(spark):
    dim = spark.createDataFrame([(2021, 1.0), (2023, 3.0)], "year int, value double")
    years = spark.createDataFrame([(y,) for y in range(2019, 2026)], "year int")
    got = {r.year: r.value for r in asof_year(years, dim).collect()}
    assert got == {2019: 1.0, 2020: 1.0, 2021: 1.0, 2022: 1.0, 2023: 3.0, 2024: 3.0, 2025: 3.0}
