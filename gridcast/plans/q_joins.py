"""Group C queries: joins against series, calendars, intervals and yearly dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import days_off_from_dates
from ..operators.joins import (anti_names, asof_year, date_flag, full_align, inner_align, interval_coverage,
                               lookup_default, neighbour_day_flags)
from .inputs import EVENT_TYPES, SQL_EVENT_GRID, SQL_EVENT_HOURLY, SQL_INTERVALS, event_grid, event_hourly, order_intervals
from .registry import Tables, query

# SQL twin of the holiday calendar (fixed dates + Orthodox Easter block) for the
# years of a ``dates(d)`` CTE; substitute days apply from 2017 and these
# queries cover 1995-2001.
SQL_HOLIDAYS = """
  yrs AS (SELECT DISTINCT year(d) AS y FROM dates),
  ea AS (SELECT y, y % 4 AS a, y % 7 AS b, y % 19 AS c FROM yrs),
  eb AS (SELECT y, a, b, (19 * c + 15) % 30 AS d FROM ea),
  ec AS (SELECT y, d, (2 * a + 4 * b - d + 34) % 7 AS e FROM eb),
  easter AS (SELECT y, make_date(y, CAST((d + e + 114) // 31 AS INTEGER), CAST((d + e + 114) % 31 + 1 AS INTEGER))
                       + INTERVAL 13 DAY AS es FROM ec),
  fixed(m, dd) AS (VALUES (1, 1), (3, 3), (5, 1), (5, 6), (5, 24), (9, 6), (9, 22), (12, 24), (12, 25), (12, 26)),
  hol AS (SELECT DISTINCT make_date(y, m, dd) AS h FROM yrs, fixed
          UNION SELECT CAST(es + o * INTERVAL 1 DAY AS DATE) FROM easter, (VALUES (-2), (-1), (0), (1)) t(o)),
  off AS (SELECT d, CASE WHEN h IS NOT NULL THEN 1 ELSE 0 END AS is_holiday FROM dates LEFT JOIN hol ON d = h
          WHERE isodow(d) >= 6 OR h IS NOT NULL)"""

_ORDER_DATES_SQL = "dates AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"


def _order_dates(t):
    return t("orders", "o_orderdate").select(F.to_date("o_orderdate").alias("date")).distinct()


@query("c2_inner_align", f"""
WITH h AS ({SQL_EVENT_HOURLY}), p AS (SELECT date_trunc('hour', ts) AS ts, sum(value) AS purchases FROM events
  WHERE event_type = 'purchase' GROUP BY 1)
SELECT h.series_id, h.ts, h.value, p.purchases FROM h JOIN p ON h.ts = p.ts""", doubles=["value", "purchases"])
def q_inner(spark, sf_dir):
    """Every hourly series aligned with the purchases on the hours that both have."""
    h = event_hourly(Tables(spark, sf_dir))
    p = h.filter(F.col("series_id") == "purchase").select("ts", F.col("value").alias("purchases"))
    return inner_align(h, p, ["ts"])


@query("c3_full_align", f"""
WITH h AS ({SQL_EVENT_HOURLY})
SELECT ts, {", ".join(f"max(value) FILTER (WHERE series_id = '{e}') AS {e}" for e in EVENT_TYPES)}
FROM h GROUP BY ts""", doubles=EVENT_TYPES)
def q_full(spark, sf_dir):
    """Five series aligned on the union of their timestamps (wide)."""
    return full_align(event_hourly(Tables(spark, sf_dir)), ["ts"], "series_id", "value", EVENT_TYPES)


@query("c4_day_off_flag", f"""
WITH {_ORDER_DATES_SQL}, {SQL_HOLIDAYS}
SELECT dates.d AS date, CASE WHEN off.d IS NOT NULL THEN 1 ELSE 0 END AS is_day_off,
       coalesce(off.is_holiday, 0) AS is_holiday
FROM dates LEFT JOIN off ON dates.d = off.d""", ints=["is_day_off", "is_holiday"], dates=["date"])
def q_dayoff(spark, sf_dir):
    """C4: day-off membership flag per date via the generated calendar (H6/H7)."""
    t = Tables(spark, sf_dir)
    dates = _order_dates(t)
    off = days_off_from_dates(spark, dates)
    flagged = date_flag(dates, F.col("date"), off, "is_day_off")
    return date_flag(flagged, F.col("date"), off.filter("is_holiday = 1"), "is_holiday")


@query("c5_lookup_default", f"""
WITH {SQL_EVENT_GRID},
e AS (SELECT date_trunc('hour', ts) AS ts, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT a.series_id, a.ts, a.value, coalesce(e.errors, 0) AS errors FROM a LEFT JOIN e USING (ts)""",
       doubles=["value"])
def q_lookup(spark, sf_dir):
    """Attach an hourly dimension (error count) with default 0."""
    t = Tables(spark, sf_dir)
    ev = t("events", "ts", "event_type").filter(F.col("event_type") == "error")
    dim = ev.groupBy(F.date_trunc("hour", "ts").alias("ts")).agg(F.count(F.lit(1)).alias("errors"))
    return lookup_default(event_grid(t), dim, ["ts"], "errors")


@query("c6_neighbour_days", f"""
WITH od AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
dates AS (SELECT CAST(unnest(generate_series(min(d) - 1, max(d) + 1, INTERVAL 1 DAY)) AS DATE) AS d FROM od),
{SQL_HOLIDAYS.strip()}
SELECT od.d AS date,
  CASE WHEN EXISTS (SELECT 1 FROM hol WHERE h = od.d + 1) THEN 1 ELSE 0 END AS pre_holiday,
  CASE WHEN EXISTS (SELECT 1 FROM hol WHERE h = od.d - 1) THEN 1 ELSE 0 END AS post_holiday,
  CASE WHEN NOT EXISTS (SELECT 1 FROM off WHERE off.d = od.d)
        AND EXISTS (SELECT 1 FROM off WHERE off.d = od.d - 1)
        AND EXISTS (SELECT 1 FROM off WHERE off.d = od.d + 1) THEN 1 ELSE 0 END AS bridge_day
FROM od""", ints=["pre_holiday", "post_holiday", "bridge_day"], dates=["date"])
def q_neighbour(spark, sf_dir):
    """Pre-holiday, post-holiday and bridge-day flags from neighbouring calendar days."""
    t = Tables(spark, sf_dir)
    dates = _order_dates(t)
    allday = dates.agg(F.min("date").alias("a"), F.max("date").alias("b")).select(
        F.explode(F.sequence(F.date_add("a", -1), F.date_add("b", 1))).alias("date"))
    off = days_off_from_dates(spark, allday)
    return neighbour_day_flags(dates, "date", off)


_TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_DAY = 86400


def _interval_sql(closed: bool, cat: str, types: list[str], with_total: bool) -> str:
    cond = 'i.start <= g.ts AND g.ts <= i."end"' if closed else 'i.start <= g.ts AND g.ts < i."end"'
    total = ", coalesce(sum(i.mw), 0) AS total" if with_total else ""
    return f"""
WITH i AS ({SQL_INTERVALS}),
b AS (SELECT min(start) AS s, max("end") AS e FROM i),
g AS (SELECT unnest(generate_series(s, e, INTERVAL 1 DAY)) AS ts FROM b),
t AS (SELECT unnest({types!r}) AS category)
SELECT t.category, g.ts, count(i.start) AS active{total}
FROM g CROSS JOIN t LEFT JOIN i ON i.{cat} = t.category AND {cond}
GROUP BY 1, 2"""


@query("c7_interval_closed_flag", _interval_sql(True, "business_type", _TYPES, False))
def q_closed(spark, sf_dir):
    """Per category and day, the number of intervals with start ≤ t ≤ end (flag = active > 0)."""
    iv = order_intervals(Tables(spark, sf_dir))
    return interval_coverage(iv, category="business_type", closed=True,
                             step_seconds=_DAY, categories=_TYPES)


_PLANTS = ["A", "N"]


@query("c8_interval_halfopen_sum", _interval_sql(False, "plant_type", _PLANTS, True), doubles=["total"])
def q_halfopen(spark, sf_dir):
    """Per known type and day, intervals with start ≤ t < end and their summed MW."""
    iv = order_intervals(Tables(spark, sf_dir))
    return interval_coverage(iv, category="plant_type",
                             value="mw", closed=False, step_seconds=_DAY, categories=_PLANTS)


@query("c9_asof_yearly", """
WITH d AS (SELECT year(o_orderdate) AS year, sum(o_totalprice) AS value FROM orders GROUP BY 1
           HAVING year(o_orderdate) NOT IN (1995, 1997, 2000)),
y AS (SELECT unnest(generate_series(min(year(o_orderdate)), max(year(o_orderdate)))) AS year FROM orders)
SELECT y.year, coalesce((SELECT value FROM d WHERE d.year <= y.year ORDER BY d.year DESC LIMIT 1),
                        (SELECT value FROM d WHERE d.year > y.year ORDER BY d.year LIMIT 1)) AS value
FROM y""", doubles=["value"], ints=["year"])
def q_asof(spark, sf_dir):
    """Yearly dimension with missing years filled as-of (previous, else next)."""
    o = Tables(spark, sf_dir)("orders", "o_orderdate", "o_totalprice")
    dim = (o.groupBy(F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("value"))
           .filter(~F.col("year").isin(1995, 1997, 2000)))
    years = o.agg(F.min(F.year("o_orderdate")).alias("a"), F.max(F.year("o_orderdate")).alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("year"))
    return asof_year(years, dim, "year", ["value"])


_ALL_TYPES = _TYPES + ["6-UNUSED"]


@query("c11_anti_untouched_types", f"""
WITH t AS (SELECT unnest({_ALL_TYPES!r}) AS business_type)
SELECT business_type FROM t WHERE business_type NOT IN (
  SELECT o_orderpriority FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate)""")
def q_anti(spark, sf_dir):
    """C11: categories with no (well-formed) interval at all."""
    iv = order_intervals(Tables(spark, sf_dir)).filter(F.col("end") > F.col("start"))
    names = spark.createDataFrame([(c,) for c in _ALL_TYPES], "business_type string")
    return anti_names(names, iv, "business_type")
