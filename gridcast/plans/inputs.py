"""Roles of the driver tables expressed as canonical inputs.

* hourly series: ``events`` summed per (event_type, hour) — five series standing
  in for generation types / locations; sf0.001 has real gaps.
* daily series: ``orders`` summed per (priority, order date) — long history.
* intervals: ``orders ⋈ lineitem`` → ``[o_orderdate, l_shipdate]`` per line,
  category = order priority (business type) or return flag (plant type),
  MW stand-in = extended price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.timegrid import align_to_grid, hourly_grid, resample
from .registry import Tables

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def event_hourly(t: Tables, how: str = "sum") -> DataFrame:
    """(series_id, ts, value): hourly aggregate of ``events.value`` per event type."""
    ev = t("events", "event_type", "ts", "value").withColumnRenamed("event_type", "series_id")
    return resample(ev, ["series_id"], "ts", ["value"], "hour", how)


def event_grid(t: Tables, how: str = "sum") -> DataFrame:
    """Hourly series aligned to its own [first, last] hourly grid; gaps are NULL."""
    h = event_hourly(t, how)
    return align_to_grid(hourly_grid(h, ["series_id"], "ts"), h, ["series_id", "ts"])


def order_daily(t: Tables) -> DataFrame:
    """(series_id, ts, value): daily total price per order priority."""
    o = t("orders", "o_orderpriority", "o_orderdate", "o_totalprice")
    return (o.groupBy(F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").alias("ts"))
            .agg(F.sum("o_totalprice").alias("value")))


def order_intervals(t: Tables) -> DataFrame:
    """Interval events: one per line item, ``start = o_orderdate``, ``end = l_shipdate``."""
    o = t("orders", "o_orderkey", "o_orderdate", "o_orderpriority")
    li = t("lineitem", "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_extendedprice",
           "l_quantity")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .select("l_orderkey", "l_linenumber", F.col("o_orderdate").alias("start"),
                    F.col("l_shipdate").alias("end"), F.col("o_orderpriority").alias("business_type"),
                    F.col("l_returnflag").alias("plant_type"), F.col("l_extendedprice").alias("mw"),
                    F.col("l_quantity").alias("avail")))


# SQL twins of the inputs, used inside oracle queries.
SQL_EVENT_HOURLY = ("SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, sum(value) AS value "
                    "FROM events GROUP BY 1, 2")
SQL_EVENT_GRID = f"""
  h AS ({SQL_EVENT_HOURLY}),
  b AS (SELECT series_id, min(ts) AS s, max(ts) AS e FROM h GROUP BY 1),
  g AS (SELECT series_id, unnest(generate_series(s, e, INTERVAL 1 HOUR)) AS ts FROM b),
  a AS (SELECT g.series_id, g.ts, h.value FROM g LEFT JOIN h USING (series_id, ts))"""
SQL_ORDER_DAILY = ("SELECT o_orderpriority AS series_id, o_orderdate AS ts, sum(o_totalprice) AS value "
                   "FROM orders GROUP BY 1, 2")
SQL_INTERVALS = ("SELECT l_orderkey, l_linenumber, o_orderdate AS start, l_shipdate AS \"end\", "
                 "o_orderpriority AS business_type, l_returnflag AS plant_type, l_extendedprice AS mw, "
                 "l_quantity AS avail FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
