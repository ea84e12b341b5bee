"""Group B and G queries: instants, grids, dedupe, fills, profiles, unions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefns import local_fields, localize_fixed_offset, parse_instant
from ..operators.timegrid import (resample, align_to_grid, completeness, dedupe, drop_empty_columns_fill_zero,
                                  dst_audit, explode_grid, fill_on_grid, hourly_grid, null_profile,
                                  priority_stitch, rebuild_comparison, schema_violations, tagged_union, trim, union_chunks)
from .inputs import EVENT_TYPES, SQL_EVENT_GRID, SQL_EVENT_HOURLY, event_grid, event_hourly
from .registry import Tables, query

_OFFSET_SQL = "CASE WHEN event_type IN ('click', 'view') THEN '+02:00' ELSE '+03:00' END"


@query("b1_parse_mixed_offsets", f"""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') || {_OFFSET_SQL} AS text,
       CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') || {_OFFSET_SQL} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS instant
FROM events""")
def q_parse(spark, sf_dir):
    """B1: text with mixed +02:00 / +03:00 offsets → one UTC instant."""
    ev = Tables(spark, sf_dir)("events", "event_id", "ts", "event_type")
    off = F.when(F.col("event_type").isin("click", "view"), "+02:00").otherwise("+03:00")
    txt = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), off)
    return ev.select("event_id", txt.alias("text"), parse_instant(txt).alias("instant"))


@query("b2_fixed_offset", "SELECT event_id, ts - INTERVAL 3 HOUR AS instant FROM events")
def q_fixed(spark, sf_dir):
    """B2: naive wall time at fixed UTC+3 (no DST) → instant."""
    ev = Tables(spark, sf_dir)("events", "event_id", "ts")
    return ev.select("event_id", localize_fixed_offset("ts", "+03:00").alias("instant"))


@query("b3_local_fields", """
WITH l AS (SELECT o_orderkey, (o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS local_ts FROM orders)
SELECT o_orderkey, local_ts, hour(local_ts) AS hour, isodow(local_ts) - 1 AS dow, dayofyear(local_ts) AS doy,
       month(local_ts) AS month, day(local_ts) AS day, CAST(local_ts AS DATE) AS local_date FROM l""",
       ints=["hour", "dow", "doy", "month", "day"], dates=["local_date"])
def q_local(spark, sf_dir):
    """Europe/Sofia wall-clock fields (Mon = 0) across six years of DST changes."""
    o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderdate")
    return o.select("o_orderkey", *[c.alias(k) for k, c in local_fields("o_orderdate").items()])


_DEDUPE_SQL = """
SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY event_id {o}) AS rn
  FROM events) WHERE rn = 1"""


def _dedupe(spark, sf_dir, keep):
    ev = Tables(spark, sf_dir)("events", "event_id", "ts", "event_type", "value")
    h = ev.select(F.col("event_type").alias("series_id"), F.date_trunc("hour", "ts").alias("ts"), "event_id", "value")
    return dedupe(h, ["series_id", "ts"], "event_id", keep)


@query("b4_dedupe_keep_first", _DEDUPE_SQL.format(o="ASC"), doubles=["value"])
def q_first(spark, sf_dir):
    """One row per (series, hour): the first by ingest ordinal."""
    return _dedupe(spark, sf_dir, "first")


@query("b5_dedupe_keep_last", _DEDUPE_SQL.format(o="DESC"), doubles=["value"])
def q_last(spark, sf_dir):
    """Keep the last row per (series, hour)."""
    return _dedupe(spark, sf_dir, "last")


@query("b6_hourly_grid", f"""
WITH {SQL_EVENT_GRID} SELECT series_id, ts FROM g""")
def q_grid(spark, sf_dir):
    """Per-series hourly grid from first to last instant."""
    return hourly_grid(event_hourly(Tables(spark, sf_dir)), ["series_id"], "ts")


@query("b7_align_to_grid", f"WITH {SQL_EVENT_GRID} SELECT * FROM a", doubles=["value"])
def q_align(spark, sf_dir):
    """Series reindexed onto its grid (missing hours → NULL)."""
    return event_grid(Tables(spark, sf_dir))


@query("b8_resample_hourly", """
SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, avg(value) AS mean, sum(value) AS total,
       count(value) AS n, arg_max(value, ts) AS last FROM events GROUP BY 1, 2""",
       doubles=["mean", "total", "last"])
def q_resample(spark, sf_dir):
    """Down-sample raw events to hours: mean, sum, count and last value."""
    ev = Tables(spark, sf_dir)("events", "event_type", "ts", "value").withColumnRenamed("event_type", "series_id")
    ev2 = ev.select("series_id", "ts", F.col("value").alias("total"), F.col("value").alias("n"),
                    F.col("value").alias("last"))
    s = ev2.groupBy("series_id", F.date_trunc("hour", "ts").alias("ts")).agg(
        F.avg("total").alias("mean"), F.sum("total").alias("total"), F.count("n").alias("n"),
        F.max_by("last", "ts").alias("last"))
    return s


@query("b8_on_the_hour", """
WITH q AS (SELECT event_type AS series_id, time_bucket(INTERVAL 15 MINUTE, ts) AS ts, sum(value) AS value
           FROM events GROUP BY 1, 2)
SELECT * FROM q WHERE ts = date_trunc('hour', ts)""", doubles=["value"])
def q_on_the_hour(spark, sf_dir):
    """Of a quarter-hour series, the value stamped on the hour itself."""
    ev = Tables(spark, sf_dir)("events", "event_type", "ts", "value")
    quarters = (ev.groupBy(F.col("event_type").alias("series_id"), F.window("ts", "15 minutes").start.alias("ts"))
                .agg(F.sum("value").alias("value")))
    return resample(quarters, ["series_id"], "ts", ["value"], "hour", "first_on_mark")


@query("b9_forward_fill", f"""
WITH {SQL_EVENT_GRID}
SELECT series_id, ts, value AS raw, last_value(value IGNORE NULLS) OVER
  (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM a""",
       doubles=["raw", "value"])
def q_ffill(spark, sf_dir):
    """Forward fill on the grid (bucketed running window + carry)."""
    g = event_grid(Tables(spark, sf_dir)).withColumn("raw", F.col("value"))
    return fill_on_grid(g, ["series_id"], "ts", ["value"], "ffill")


_COMMON_GRID_SQL = f"""
  h AS ({SQL_EVENT_HOURLY}),
  b AS (SELECT min(ts) AS s, max(ts) AS e FROM h),
  k AS (SELECT DISTINCT series_id FROM h),
  g AS (SELECT series_id, unnest(generate_series(s, e, INTERVAL 1 HOUR)) AS ts FROM k, b),
  a AS (SELECT g.series_id, g.ts, h.value FROM g LEFT JOIN h USING (series_id, ts))"""


def _global_grid(t):
    h = event_hourly(t)
    b = h.agg(F.min("ts").alias("grid_start"), F.max("ts").alias("grid_end"))
    keys = h.select("series_id").distinct()
    return align_to_grid(explode_grid(keys.crossJoin(b), ["series_id"]), h, ["series_id", "ts"])


@query("b10_ffill_bfill", f"""
WITH {_COMMON_GRID_SQL},
f AS (SELECT series_id, ts, value AS raw, last_value(value IGNORE NULLS) OVER
      (PARTITION BY series_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM a)
SELECT series_id, ts, raw, coalesce(v, first_value(v IGNORE NULLS) OVER
  (PARTITION BY series_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM f""",
       doubles=["raw", "value"])
def q_ffill_bfill(spark, sf_dir):
    """Forward then backward fill on a grid shared by all series (leading gaps get the next value)."""
    g = _global_grid(Tables(spark, sf_dir)).withColumn("raw", F.col("value"))
    return fill_on_grid(g, ["series_id"], "ts", ["value"], "ffill_bfill")


@query("b12_trim", f"""
WITH {SQL_EVENT_GRID} SELECT * FROM a WHERE ts >= TIMESTAMP '2024-01-08 00:00:00' AND value IS NOT NULL""",
       doubles=["value"])
def q_trim(spark, sf_dir):
    """Keep rows at/after the cut with the target present."""
    return trim(event_grid(Tables(spark, sf_dir)), "ts", "2024-01-08 00:00:00", ["value"])


@query("b13_drop_incomplete", f"""
WITH {_COMMON_GRID_SQL}
SELECT series_id, count(*) AS rows, count_if(value IS NULL) AS dropped FROM a GROUP BY 1""")
def q_dropna(spark, sf_dir):
    """Rows and dropped-row counts for a complete-case filter, per series."""
    g = _global_grid(Tables(spark, sf_dir))
    cond = F.col("value").isNull()
    return g.groupBy("series_id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(cond).alias("dropped"))


_WIDE_TYPES = EVENT_TYPES + ["refund"]
_PIVOT_SQL = ("w AS (SELECT date_trunc('hour', ts) AS ts, "
              + ", ".join(f"sum(value) FILTER (WHERE event_type = '{e}') AS {e}" for e in _WIDE_TYPES)
              + " FROM events GROUP BY 1)")


def _wide(t):
    ev = t("events", "event_type", "ts", "value")
    return ev.groupBy(F.date_trunc("hour", "ts").alias("ts")).pivot("event_type", _WIDE_TYPES).agg(F.sum("value"))


@query("b14_drop_empty_fill_zero", f"""
WITH {_PIVOT_SQL} SELECT ts, {", ".join(f"coalesce({e}, 0.0) AS {e}" for e in EVENT_TYPES)} FROM w""",
       doubles=EVENT_TYPES)
def q_drop_empty(spark, sf_dir):
    """Wide hourly table; the all-NULL ``refund`` column is dropped, other gaps → 0."""
    return drop_empty_columns_fill_zero(_wide(Tables(spark, sf_dir)), _WIDE_TYPES)


@query("b15_null_profile", f"""
WITH {_PIVOT_SQL}
SELECT unnest({_WIDE_TYPES!r}) AS "column", unnest([{", ".join(f"count_if({e} IS NULL)" for e in _WIDE_TYPES)}]) AS nulls,
       count(*) AS rows FROM w""")
def q_null_profile(spark, sf_dir):
    """NULL count per column of the wide hourly table."""
    return null_profile(_wide(Tables(spark, sf_dir)), _WIDE_TYPES)


@query("b15_completeness", f"""
WITH {_PIVOT_SQL}
SELECT count(*) AS rows, count_if({" AND ".join(f"{e} IS NOT NULL" for e in EVENT_TYPES)}) AS complete_rows,
       min(ts) AS first_ts, max(ts) AS last_ts FROM w""")
def q_completeness(spark, sf_dir):
    """Rows, complete rows and range of the wide hourly table."""
    return completeness(_wide(Tables(spark, sf_dir)), EVENT_TYPES, "ts")


#: A contract that ``events`` does not keep: another type, a missing and an undeclared column.
_CONTRACT = T.StructType([
    T.StructField("event_id", T.LongType(), False), T.StructField("ts", T.TimestampType(), False),
    T.StructField("event_type", T.StringType(), False), T.StructField("value", T.DecimalType(10, 2)),
    T.StructField("user_id", T.LongType(), False), T.StructField("source", T.StringType())])


@query("b16_schema_contract", """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (WHERE event_id IS NULL) AS a, count(*) FILTER (WHERE ts IS NULL) AS b,
  count(*) FILTER (WHERE event_type IS NULL) AS c, count(*) FILTER (WHERE user_id IS NULL) AS d FROM events),
v AS (SELECT 'source' AS "column", 'missing' AS problem, 'string' AS declared, NULL AS found, n AS rows FROM n
  UNION ALL SELECT 'value', 'type', 'decimal(10,2)', 'double', n FROM n
  UNION ALL SELECT 'props', 'undeclared', NULL, 'string', n FROM n
  UNION ALL SELECT 'event_id', 'null', 'bigint', 'bigint', a FROM n UNION ALL SELECT 'ts', 'null', 'timestamp', 'timestamp', b FROM n
  UNION ALL SELECT 'event_type', 'null', 'string', 'string', c FROM n UNION ALL SELECT 'user_id', 'null', 'bigint', 'bigint', d FROM n)
SELECT * FROM v WHERE problem <> 'null' OR rows > 0""", ints=["rows"])
def q_contract(spark, sf_dir):
    """Columns that are missing, undeclared, of another type, or NULL where the contract allows none."""
    return schema_violations(Tables(spark, sf_dir)("events"), _CONTRACT)


@query("b17_rebuild_comparison", f"""
WITH n AS ({SQL_EVENT_HOURLY}),
o AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, sum(value) + 0.5 * count(*) AS value
      FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1, 2),
j AS (SELECT n.value AS nv, o.value AS ov, n.ts IS NOT NULL AS in_n, o.ts IS NOT NULL AS in_o
      FROM n FULL JOIN o USING (series_id, ts))
SELECT count_if(in_n) AS rows_new, count_if(in_o) AS rows_old, count_if(in_n AND in_o) AS rows_common,
       max(abs(nv - ov)) AS max_abs_diff, true AS same_columns FROM j""", doubles=["max_abs_diff"])
def q_rebuild(spark, sf_dir):
    """Compare a rebuilt table with the previous one (row counts, max target change)."""
    t = Tables(spark, sf_dir)
    new = event_hourly(t)
    ev = t("events", "event_type", "ts", "value").filter(F.col("ts") < F.lit("2024-01-20 00:00:00").cast("timestamp"))
    old = ev.groupBy(F.col("event_type").alias("series_id"), F.date_trunc("hour", "ts").alias("ts")).agg(
        (F.sum("value") + 0.5 * F.count(F.lit(1))).alias("value"))
    return rebuild_comparison(new, old, ["series_id", "ts"], "value")


@query("b18_dst_audit", """
WITH b AS (SELECT min(o_orderdate) AS s, max(o_orderdate) AS e FROM orders),
g AS (SELECT unnest(generate_series(s, e, INTERVAL 1 HOUR)) AS ts FROM b)
SELECT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE) AS local_date, count(*) AS hours
FROM g GROUP BY 1 HAVING count(*) <> 24""", dates=["local_date"])
def q_dst(spark, sf_dir):
    """Local days with 23 or 25 hourly instants on the hourly grid spanning the orders."""
    o = Tables(spark, sf_dir)("orders", "o_orderdate")
    b = o.agg(F.min("o_orderdate").alias("grid_start"), F.max("o_orderdate").alias("grid_end"))
    return dst_audit(explode_grid(b, []), "ts")


# --- G: set operations ------------------------------------------------------------

@query("g1_union_chunks_dedupe", """
WITH c AS (SELECT 1 AS chunk, event_id, ts, value FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00'
           UNION ALL
           SELECT 2, event_id, ts, value * 2 FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00')
SELECT chunk, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY ts ORDER BY chunk) AS rn FROM c) WHERE rn = 1""",
       doubles=["value"], ints=["chunk"])
def q_union(spark, sf_dir):
    """G1: overlapping download chunks unioned, de-duplicated by timestamp, earlier chunk wins."""
    ev = Tables(spark, sf_dir)("events", "event_id", "ts", "value")
    cut1, cut2 = F.lit("2024-01-20 00:00:00").cast("timestamp"), F.lit("2024-01-10 00:00:00").cast("timestamp")
    c1 = ev.filter(F.col("ts") < cut1).withColumn("chunk", F.lit(1))
    c2 = ev.filter(F.col("ts") >= cut2).withColumn("value", F.col("value") * 2).withColumn("chunk", F.lit(2))
    return union_chunks([c1, c2], ["ts"], ["chunk"]).select("chunk", "event_id", "ts", "value")


@query("g2_tagged_union", """
SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, sum(value) AS value, 1 AS seq FROM events GROUP BY 1, 2
UNION ALL SELECT event_type, date_trunc('hour', ts), avg(value), 2 FROM events GROUP BY 1, 2
UNION ALL SELECT event_type, date_trunc('hour', ts), max(value), 3 FROM events GROUP BY 1, 2""",
       doubles=["value"], ints=["seq"])
def q_tagged(spark, sf_dir):
    """Three auction-like tables unioned with a 1..3 sequence tag, no de-duplication."""
    t = Tables(spark, sf_dir)
    return tagged_union([event_hourly(t, "sum"), event_hourly(t, "mean"), event_hourly(t, "max")], "seq")


@query("g3_priority_stitch", """
WITH arc AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, sum(value) AS value FROM events
             GROUP BY 1, 2 HAVING date_trunc('hour', ts) <= TIMESTAMP '2024-01-20 00:00:00'),
fc AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, avg(value) AS value FROM events GROUP BY 1, 2),
u AS (SELECT *, 'archive' AS source, 0 AS prio FROM arc UNION ALL SELECT *, 'forecast', 1 FROM fc)
SELECT series_id, ts, value, source FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id, ts ORDER BY prio) AS rn FROM u) WHERE rn = 1""",
       doubles=["value"])
def q_stitch(spark, sf_dir):
    """Archive up to a cut, forecast tail after; archive wins overlaps; source tag."""
    t = Tables(spark, sf_dir)
    return priority_stitch(event_hourly(t, "sum"), event_hourly(t, "mean"), ["series_id", "ts"], "ts",
                           "2024-01-20 00:00:00")


@query("g4_intersect_keys", "SELECT o_orderdate AS ts FROM orders INTERSECT SELECT l_shipdate FROM lineitem")
def q_intersect(spark, sf_dir):
    """Days with both an order and a shipment."""
    t = Tables(spark, sf_dir)
    return t("orders", "o_orderdate").select(F.col("o_orderdate").alias("ts")).intersect(t("lineitem", "l_shipdate"))


@query("g5_difference_keys", "SELECT l_shipdate AS ts FROM lineitem EXCEPT SELECT o_orderdate FROM orders")
def q_except(spark, sf_dir):
    """Days with shipments and no order (anti join)."""
    t = Tables(spark, sf_dir)
    shipped = t("lineitem", "l_shipdate").select(F.col("l_shipdate").alias("ts")).distinct()
    return shipped.join(t("orders", "o_orderdate").select(F.col("o_orderdate").alias("ts")), "ts", "left_anti")
