"""I26/I28 queries: supply, day-ahead and week-ahead masters on the event tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import days_off_from_dates
from ..session import cut_lineage
from ..operators.aggregates import standardize
from .features import SUPPLY_FLAGS, SUPPLY_WEATHER, supply_features
from .masters import day_ahead_master, supply_master, week_ahead_master
from .q_joins import SQL_HOLIDAYS
from .registry import Tables, query
from .trees import supply_models

GEN = ["click", "error", "signup", "view"]
CUT = "2024-01-02 00:00:00"
SPLIT = "2024-01-20 00:00:00"
WX_MASTER = ["temp_c", "wind10_ms", "wind100_ms", "ghi_wm2", "dni_wm2", "cloud_pct", "precip_mm", "rh_pct"]


def _weather_aggs(names):
    v = F.col("value")
    exprs = [F.avg(v) / 10 - 5, F.count(F.lit(1)).cast("double"), F.max(v) / 10, F.pmod(F.sum(v) * 10, F.lit(360.0)),
             F.sum(v), F.min(v), F.stddev_samp(v), F.avg(v) - F.min(v), F.max(v) - F.min(v)]
    return [e.alias(n) for e, n in zip(exprs, names)]


_WX_SQL = ["avg(value) / 10 - 5", "CAST(count(*) AS DOUBLE)", "max(value) / 10", "((sum(value) * 10) % 360 + 360) % 360",
           "sum(value)", "min(value)", "stddev_samp(value)", "avg(value) - min(value)", "max(value) - min(value)"]
_CATS = "CASE WHEN k < 34 THEN 'prod_maint' WHEN k < 67 THEN 'gen_maint' ELSE 'gen_outages' END"


def _supply_inputs(spark, t):
    ev = t("events", "event_type", "ts", "value", "props")
    hour = F.date_trunc("hour", "ts").alias("ts")

    def total(kind, name):
        return F.sum(F.when(F.col("event_type") == kind, F.col("value"))).alias(name)

    # one pass for all roles; the hours are bounded by the calendar and written once
    hours = cut_lineage(ev.groupBy(hour).agg(*[total(g, g) for g in GEN], total("purchase", "net_position"), *_weather_aggs(SUPPLY_WEATHER)))
    gen = hours.unpivot("ts", GEN, "type", "value").where("value IS NOT NULL")
    net, wx = hours.select("ts", "net_position"), hours.select("ts", *SUPPLY_WEATHER)
    k = F.regexp_extract("props", r'"k": ([^}]*)', 1).try_cast("int")
    out = (ev.filter(F.col("event_type") == "error")
           .select(F.when(k < 34, "prod_maint").when(k < 67, "gen_maint").otherwise("gen_outages").alias("category"),
                   F.col("ts").alias("start"),
                   (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int"))).alias("end")))
    dates = wx.select(F.to_date(F.from_utc_timestamp("ts", "Europe/Sofia")).alias("date")).distinct()
    cal = cut_lineage(days_off_from_dates(spark, dates))  # a calendar, made once
    return gen, net, wx, cal, out


def _supply(spark, sf_dir):
    gen, net, wx, cal, out = _supply_inputs(spark, Tables(spark, sf_dir))
    return supply_master(gen, net, wx, cal, out, types=GEN, weather_cols=SUPPLY_WEATHER, cut=CUT)


def _ffill(c):
    return f"last_value({c} IGNORE NULLS) OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"


_SUPPLY_SQL = f"""
WITH hrs AS (SELECT date_trunc('hour', ts) AS ts, * EXCLUDE (ts) FROM events),
gen AS (SELECT ts, {", ".join(f"sum(value) FILTER (WHERE event_type = '{g}') AS {g}" for g in GEN)}
        FROM hrs WHERE event_type IN ({", ".join(f"'{g}'" for g in GEN)}) GROUP BY ts),
bnd AS (SELECT min(ts) AS s, max(ts) AS e FROM hrs WHERE event_type IN ({", ".join(f"'{g}'" for g in GEN)})),
grid AS (SELECT unnest(generate_series(s, e, INTERVAL 1 HOUR)) AS ts FROM bnd),
net AS (SELECT ts, sum(value) AS net_position FROM hrs WHERE event_type = 'purchase' GROUP BY ts),
wx AS (SELECT ts, {", ".join(f"{e} AS {n}" for e, n in zip(_WX_SQL, SUPPLY_WEATHER))} FROM hrs GROUP BY ts),
j AS (SELECT grid.ts, gen.* EXCLUDE (ts), net.net_position, wx.* EXCLUDE (ts) FROM grid LEFT JOIN gen USING (ts)
      LEFT JOIN net USING (ts) LEFT JOIN wx USING (ts)),
f AS (SELECT ts, {", ".join(_ffill(c) for c in GEN + ["net_position"] + SUPPLY_WEATHER)} FROM j),
dates AS (SELECT DISTINCT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE) AS d FROM wx),
{SQL_HOLIDAYS.strip()},
iv AS (SELECT {_CATS} AS category, ts AS start, ts + CAST(floor(value) AS INTEGER) * INTERVAL 1 MINUTE AS "end"
       FROM (SELECT ts, value, TRY_CAST(regexp_extract(props, '"k": ([^}}]*)', 1) AS INTEGER) AS k FROM events
             WHERE event_type = 'error')),
fl AS (SELECT f.ts, {", ".join(f"max(CASE WHEN iv.category = '{c}' THEN 1 ELSE 0 END) AS {c}" for c in ("prod_maint", "gen_maint", "gen_outages"))}
       FROM f LEFT JOIN iv ON iv.start <= f.ts AND f.ts <= iv."end" GROUP BY f.ts),
m AS (SELECT f.*, {" + ".join(f"coalesce({g}, 0)" for g in GEN)} + net_position AS supply,
             CASE WHEN isodow(CAST((f.ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE)) >= 6 THEN 1 ELSE 0 END
               AS is_weekend,
             coalesce(off.is_holiday, 0) AS is_holiday, fl.prod_maint, fl.gen_maint, fl.gen_outages
      FROM f JOIN fl USING (ts)
      LEFT JOIN off ON off.d = CAST((f.ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE))
SELECT * FROM m WHERE ts >= TIMESTAMP '{CUT}' AND supply IS NOT NULL"""


@query("i28_supply_master", _SUPPLY_SQL, doubles=["supply", *GEN, "net_position", *SUPPLY_WEATHER],
       ints=["is_weekend", "is_holiday", "prod_maint", "gen_maint", "gen_outages"])
def q_supply(spark, sf_dir):
    """Supply master — grid, forward fills, row sum, calendar and outage flags."""
    return _supply(spark, sf_dir)


@query("i26_supply_features", f"""
WITH s AS ({_SUPPLY_SQL})
SELECT ts, supply, {", ".join(SUPPLY_WEATHER)}, {", ".join(SUPPLY_FLAGS)} FROM s
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SUPPLY_WEATHER + SUPPLY_FLAGS)}""",
       doubles=["supply", *SUPPLY_WEATHER], ints=SUPPLY_FLAGS)
def q_supply_features(spark, sf_dir):
    """Supply feature table (9 weather + 5 flags, complete rows)."""
    return supply_features(_supply(spark, sf_dir))


_DA_SQL = f"""
WITH load AS (SELECT date_trunc('hour', ts) AS ts, sum(value) AS load FROM events GROUP BY 1),
fc AS (SELECT date_trunc('hour', ts) AS ts, sum(value) * 0.9 AS forecast FROM events
       WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1),
wx AS (SELECT date_trunc('hour', ts) AS ts, {", ".join(f"{e} AS {n}" for e, n in zip(_WX_SQL[:2] + _WX_SQL[2:3] + _WX_SQL[4:], WX_MASTER))}
       FROM events GROUP BY 1),
b AS (SELECT greatest(min(ts), TIMESTAMP '{CUT}') AS s, max(ts) AS e FROM load),
g AS (SELECT unnest(generate_series(s, e, INTERVAL 1 HOUR)) AS ts FROM b),
dates AS (SELECT DISTINCT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE) AS d FROM g),
{SQL_HOLIDAYS.strip()}
SELECT g.ts, load.load AS load_actual_mw, fc.forecast AS load_forecast_mw, wx.* EXCLUDE (ts),
       CASE WHEN off.d IS NOT NULL THEN 1 ELSE 0 END AS is_day_off
FROM g LEFT JOIN load USING (ts) LEFT JOIN fc USING (ts) LEFT JOIN wx USING (ts)
LEFT JOIN off ON off.d = CAST((g.ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE)
WHERE g.ts >= TIMESTAMP '{CUT}' AND load.load IS NOT NULL"""


def _da_inputs(spark, t):
    ev = t("events", "event_type", "ts", "value")
    hour = F.date_trunc("hour", "ts").alias("ts")
    load = ev.groupBy(hour).agg(F.sum("value").alias("load"))
    fc = (ev.filter(F.col("event_type").isin("click", "view", "purchase")).groupBy(hour)
          .agg((F.sum("value") * 0.9).alias("forecast")))
    names = WX_MASTER[:3] + ["_dir"] + WX_MASTER[3:]
    wx = ev.groupBy(hour).agg(*_weather_aggs(names)).drop("_dir")
    return load, fc, wx


@query("i28_day_ahead_master", _DA_SQL, doubles=["load_actual_mw", "load_forecast_mw", *WX_MASTER], ints=["is_day_off"])
def q_day_ahead(spark, sf_dir):
    """Day-ahead master — load, operator forecast, weather forecast, day-off flag."""
    t = Tables(spark, sf_dir)
    load, fc, wx = _da_inputs(spark, t)
    dates = load.select(F.to_date(F.from_utc_timestamp("ts", "Europe/Sofia")).alias("date")).distinct()
    return day_ahead_master(load, fc, wx, days_off_from_dates(spark, dates), cut=CUT, weather_cols=WX_MASTER)


_WA_SQL = f"""
WITH load AS (SELECT date_trunc('hour', ts) AS ts, sum(value) AS load FROM events GROUP BY 1),
wx AS (SELECT date_trunc('hour', ts) AS ts, {", ".join(f"{e} AS {n}" for e, n in zip(_WX_SQL[:3] + _WX_SQL[4:], WX_MASTER))}
       FROM events GROUP BY 1),
b AS (SELECT greatest((SELECT min(ts) FROM load), (SELECT min(ts) FROM wx)) AS s,
             least((SELECT max(ts) FROM load), (SELECT max(ts) FROM wx)) AS e),
g AS (SELECT unnest(generate_series(s, e, INTERVAL 1 HOUR)) AS ts FROM b),
dates AS (SELECT DISTINCT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE) AS d FROM load),
{SQL_HOLIDAYS.strip()}
SELECT g.ts, load.load AS load_actual_mw, wx.* EXCLUDE (ts), CASE WHEN off.d IS NOT NULL THEN 1 ELSE 0 END AS is_day_off
FROM g LEFT JOIN load USING (ts) LEFT JOIN wx USING (ts)
LEFT JOIN off ON off.d = CAST((g.ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE)
WHERE g.ts >= TIMESTAMP '{CUT}' AND load.load IS NOT NULL"""


@query("i28_week_ahead_master", _WA_SQL, doubles=["load_actual_mw", *WX_MASTER], ints=["is_day_off"])
def q_week_ahead(spark, sf_dir):
    """Week-ahead master — weather actuals in naive UTC+3 localised, common grid."""
    t = Tables(spark, sf_dir)
    load, _, wx = _da_inputs(spark, t)
    naive = wx.withColumn("ts", F.from_utc_timestamp("ts", "+03:00"))  # stamp as naive UTC+3 wall time
    dates = load.select(F.to_date(F.from_utc_timestamp("ts", "Europe/Sofia")).alias("date")).distinct()
    return week_ahead_master(load, naive, days_off_from_dates(spark, dates), cut=CUT, weather_cols=WX_MASTER)


@query("i7_supply_tree_models")
def q_supply_models(spark, sf_dir):
    """Lasso, ridge, elastic net, decision tree, random forest (100), gradient boosting (100 rounds)
    and naive on the standardised supply features; MSE, RMSE, MAE, MAPE of the last third."""
    f = supply_features(_supply(spark, sf_dir))
    return supply_models(f, "ts", "supply", SUPPLY_WEATHER + SUPPLY_FLAGS, SPLIT)


@query("d10_standardize_supply", f"""
WITH s AS ({_SUPPLY_SQL}),
f AS (SELECT ts, supply, {", ".join(SUPPLY_WEATHER + SUPPLY_FLAGS)} FROM s
      WHERE {" AND ".join(f"{c} IS NOT NULL" for c in SUPPLY_WEATHER + SUPPLY_FLAGS)})
SELECT ts, {", ".join(f"(c0 - avg(c0) OVER ()) / stddev_samp(c0) OVER () AS c0".replace("c0", c) for c in ["supply", *SUPPLY_WEATHER])},
       {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SUPPLY_FLAGS)} FROM f""",
       doubles=["supply", *SUPPLY_WEATHER, *SUPPLY_FLAGS])
def q_standardize_supply(spark, sf_dir):
    """Supply features as z-scores with the sample deviation (ddof 1); 0/1 columns stay."""
    f = supply_features(_supply(spark, sf_dir))
    return standardize(f, ["supply", *SUPPLY_WEATHER, *SUPPLY_FLAGS], ddof=1, keep_dummies=True)
