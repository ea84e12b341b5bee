"""Group H queries: calendar harmonics, degree days, holidays, numeric helpers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import (cyclical_calendar, days_off_from_dates, easter_orthodox, holiday_calendar,
                                  holiday_classes, hour_harmonics)
from ..functions.numeric import clip, degree_days
from ..functions.timefns import local_fields, reformat_timestamp
from ..operators.joins import date_flag
from .inputs import SQL_EVENT_GRID, event_grid
from .q_joins import SQL_HOLIDAYS, _ORDER_DATES_SQL, _order_dates
from .registry import Tables, query

_LOCAL = "((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia')"
_HOURS_SQL = f"""
  hrs AS (SELECT DISTINCT date_trunc('hour', ts) AS ts FROM events),
  dates AS (SELECT DISTINCT CAST({_LOCAL} AS DATE) AS d FROM hrs)"""


def _hours_with_dayoff(spark, t):
    ev = t("events", "ts")
    hrs = ev.select(F.date_trunc("hour", "ts").alias("ts")).distinct()
    lf = local_fields("ts")
    h = hrs.select("ts", lf["hour"].alias("hour"), lf["dow"].alias("dow"), lf["doy"].alias("doy"),
                   lf["month"].alias("month"), lf["day"].alias("day"), lf["local_date"].alias("local_date"))
    dates = h.select(F.col("local_date").alias("date")).distinct()
    off = days_off_from_dates(spark, dates)
    h = date_flag(h, F.col("local_date"), off, "is_day_off")
    return date_flag(h, F.col("local_date"), off.filter("is_holiday = 1"), "is_holiday")


def _harm_sql(k, f):
    return f"{f}(2 * pi() * {k} * hour(l) / 24)"


@query("h1_hour_harmonics", f"""
WITH {_HOURS_SQL}, {SQL_HOLIDAYS},
x AS (SELECT ts, {_LOCAL} AS l FROM hrs),
y AS (SELECT ts, l, CASE WHEN off.d IS NULL THEN 1 ELSE 0 END AS workday FROM x
      LEFT JOIN off ON off.d = CAST(l AS DATE))
SELECT ts, workday, {", ".join(f"{_harm_sql(k, fn)} AS {fn}{k}h, {_harm_sql(k, fn)} * workday AS {fn}{k}h_workday"
                               for k in (1, 2, 3) for fn in ("sin", "cos"))} FROM y""",
       doubles=[f"{fn}{k}h{s}" for k in (1, 2, 3) for fn in ("sin", "cos") for s in ("", "_workday")],
       ints=["workday"])
def q_harmonics(spark, sf_dir):
    """H1: hour-of-day harmonics k = 1..3 and their workday interactions."""
    h = _hours_with_dayoff(spark, Tables(spark, sf_dir)).withColumn("workday", 1 - F.col("is_day_off"))
    return h.select("ts", "workday", *[c.alias(n) for n, c in hour_harmonics(F.col("hour"), F.col("workday")).items()])


@query("h2_calendar_cycles", f"""
WITH hrs AS (SELECT DISTINCT date_trunc('hour', ts) AS ts FROM events), x AS (SELECT ts, {_LOCAL} AS l FROM hrs)
SELECT ts, sin(2 * pi() * (isodow(l) - 1) / 7) AS sindow, cos(2 * pi() * (isodow(l) - 1) / 7) AS cosdow,
       sin(2 * pi() * dayofyear(l) / 365.25) AS sin_doy, cos(2 * pi() * dayofyear(l) / 365.25) AS cos_doy FROM x""",
       doubles=["sindow", "cosdow", "sin_doy", "cos_doy"])
def q_cycles(spark, sf_dir):
    """H2: day-of-week and day-of-year cycles in local time."""
    ev = Tables(spark, sf_dir)("events", "ts")
    lf = local_fields(F.date_trunc("hour", "ts"))
    h = ev.select(F.date_trunc("hour", "ts").alias("ts"), lf["dow"].alias("dow"), lf["doy"].alias("doy")).distinct()
    return h.select("ts", *[c.alias(n) for n, c in cyclical_calendar(F.col("dow"), F.col("doy")).items()])


_TEMP = "(value / 10 - 5)"


@query("h3_degree_days", f"""
WITH {SQL_EVENT_GRID}
SELECT series_id, ts, {_TEMP} AS temp, CASE WHEN value IS NOT NULL THEN greatest(18 - {_TEMP}, 0) END AS hdd,
       CASE WHEN value IS NOT NULL THEN greatest({_TEMP} - 22, 0) END AS cdd, power({_TEMP}, 2) AS t_sq FROM a""",
       doubles=["temp", "hdd", "cdd", "t_sq"])
def q_degree(spark, sf_dir):
    """H3: heating/cooling degrees and temperature squared; NULL temperature stays NULL."""
    g = event_grid(Tables(spark, sf_dir)).withColumn("temp", F.col("value") / 10 - 5)
    return g.select("series_id", "ts", "temp", *[c.alias(n) for n, c in degree_days(F.col("temp")).items()])


@query("h4_degree_day_interactions", f"""
WITH {_HOURS_SQL}, {SQL_HOLIDAYS},
t AS (SELECT date_trunc('hour', ts) AS ts, avg(value) / 10 - 5 AS temp FROM events GROUP BY 1),
x AS (SELECT t.ts, temp, CASE WHEN off.d IS NULL THEN 0 ELSE 1 END AS is_day_off FROM t
      LEFT JOIN off ON off.d = CAST({_LOCAL.replace("ts", "t.ts")} AS DATE))
SELECT ts, is_day_off, greatest(18 - temp, 0) * is_day_off AS hdd_x_dayoff,
       greatest(temp - 22, 0) * is_day_off AS cdd_x_dayoff FROM x""",
       doubles=["hdd_x_dayoff", "cdd_x_dayoff"], ints=["is_day_off"])
def q_interactions(spark, sf_dir):
    """H4: degree days × day-off flag."""
    t = Tables(spark, sf_dir)
    h = _hours_with_dayoff(spark, t).select("ts", "is_day_off")
    ev = t("events", "ts", "value")
    temp = ev.groupBy(F.date_trunc("hour", "ts").alias("ts")).agg((F.avg("value") / 10 - 5).alias("temp"))
    dd = degree_days(F.col("temp"))
    return temp.join(h, "ts").select("ts", "is_day_off", (dd["hdd"] * F.col("is_day_off")).alias("hdd_x_dayoff"),
                                     (dd["cdd"] * F.col("is_day_off")).alias("cdd_x_dayoff"))


@query("h5_holiday_classes", f"""
WITH {_ORDER_DATES_SQL}, {SQL_HOLIDAYS},
x AS (SELECT d, CASE WHEN h IS NULL THEN 0.0 ELSE 1.0 END AS is_holiday FROM dates LEFT JOIN hol ON h = d),
y AS (SELECT d, is_holiday, CASE WHEN month(d) IN (4, 5) AND day(d) <= 10 THEN 1.0 ELSE 0.0 END * is_holiday AS em FROM x)
SELECT d AS date, em AS hol_easter_may, least(greatest(is_holiday - em, 0), 1) AS hol_other FROM y""",
       doubles=["hol_easter_may", "hol_other"], dates=["date"])
def q_holclass(spark, sf_dir):
    """H5: Easter/May holiday class and other holidays."""
    t = Tables(spark, sf_dir)
    dates = _order_dates(t)
    hol = holiday_calendar(spark, dates.select(F.year("date").alias("year")))
    d = date_flag(dates, F.col("date"), hol, "is_holiday").withColumn("is_holiday", F.col("is_holiday").cast("double"))
    c = holiday_classes(F.month("date"), F.dayofmonth("date"), F.col("is_holiday"))
    return d.select("date", c["hol_easter_may"].alias("hol_easter_may"), c["hol_other"].alias("hol_other"))


@query("h6_days_off_calendar", """
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e FROM orders),
dates AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM b), """ + SQL_HOLIDAYS.strip()
       + """
SELECT d AS date, dayname(d) AS day_name, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend, is_holiday FROM off""",
       ints=["is_weekend", "is_holiday"], dates=["date"])
def q_daysoff(spark, sf_dir):
    """H6: days-off calendar (weekends + holidays only) over the data's date span."""
    o = Tables(spark, sf_dir)("orders", "o_orderdate")
    dates = o.agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("date"))
    return days_off_from_dates(spark, dates)


@query("h7_orthodox_easter", """
WITH dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), """ + SQL_HOLIDAYS.strip()
       + " SELECT y AS year, CAST(es AS DATE) AS easter FROM easter", ints=["year"], dates=["easter"])
def q_easter(spark, sf_dir):
    """H7: Orthodox Easter Sunday for each year in the data."""
    years = _order_dates(Tables(spark, sf_dir)).select(F.year("date").alias("year")).distinct()
    return years.select("year", easter_orthodox(F.col("year")).alias("easter"))


@query("h9_clip_abs_finite", """
SELECT event_id, CASE WHEN value IS NOT NULL THEN least(greatest(value - 100, 0), 200) END AS clipped,
       abs(value - 100) AS dist, isfinite(value) AS finite FROM events""",
       doubles=["clipped", "dist"])
def q_clip(spark, sf_dir):
    """H9: clip (NULL-preserving), abs, finiteness test."""
    ev = Tables(spark, sf_dir)("events", "event_id", "value")
    finite = ~(F.isnan("value") | (F.abs("value") == float("inf")))
    return ev.select("event_id", clip(F.col("value") - 100, 0.0, 200.0).alias("clipped"),
                     F.abs(F.col("value") - 100).alias("dist"), finite.alias("finite"))


@query("h10_timestamp_reformat", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M') AS text, date_trunc('minute', ts) AS parsed FROM events""")
def q_reformat(spark, sf_dir):
    """``yyyy-MM-dd'T'HH:mm`` text ↔ instant."""
    ev = Tables(spark, sf_dir)("events", "event_id", "ts")
    txt = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    return ev.select("event_id", txt.alias("text"), reformat_timestamp(txt).alias("parsed"))


@query("h11_direction_math", """
SELECT event_id, radians(value) AS rad, degrees(atan2(value, 100)) AS deg,
       ((value * 10) % 360 + 360) % 360 AS bearing FROM events""", doubles=["rad", "deg", "bearing"])
def q_direction(spark, sf_dir):
    """Radians / degrees / atan2 / modulo-360 helpers."""
    ev = Tables(spark, sf_dir)("events", "event_id", "value")
    return ev.select("event_id", F.radians("value").alias("rad"), F.degrees(F.atan2("value", F.lit(100.0))).alias("deg"),
                     F.pmod(F.col("value") * 10, F.lit(360.0)).alias("bearing"))
