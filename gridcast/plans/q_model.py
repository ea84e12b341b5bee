"""Group I queries: folds, Gram tables, walk-forward models, conformal, ramps, features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.calendar import days_off_from_dates
from ..operators.aggregates import interval_quality
from ..operators.windows import Lookback, lag_columns, lookback_features, with_position
from ..session import cut_lineage
from .evaluate import linear_ramp, mondrian_widths
from .features import HORIZONS, build_features, feature_block, feature_columns, features_sql
from .folds import chronological_split, fold_row_counts, fold_table
from .inputs import SQL_ORDER_DAILY, order_daily
from .linear import gram_table, walk_forward_linear
from .q_aggs import SQL_PRED, predictions
from .q_joins import SQL_HOLIDAYS
from .registry import Tables, query

DAY = 86400
# fixed values of the reference: block and window lengths
TEST0, TEST_DAYS, TRAIN_DAYS = "2000-01-01 00:00:00", 15, 730


def _daily_end(t):
    return order_daily(t).agg(F.max("ts").alias("end"))


def _folds(spark, t, cal_days=0):
    return fold_table(spark, TEST0, _daily_end(t), test_seconds=TEST_DAYS * DAY, train_seconds=TRAIN_DAYS * DAY,
                      cal_seconds=cal_days * DAY, step_seconds=DAY)


_FOLDS_SQL = f"""
  e AS (SELECT max(o_orderdate) AS e FROM orders),
  s AS (SELECT unnest(generate_series(TIMESTAMP '{TEST0}', e, INTERVAL {TEST_DAYS} DAY)) AS test_start, e FROM e),
  f AS (SELECT row_number() OVER (ORDER BY test_start) AS fold_id, test_start - INTERVAL {TRAIN_DAYS} DAY AS train_start,
               test_start AS cal_start, test_start, least(test_start + INTERVAL {TEST_DAYS} DAY, e + INTERVAL 1 DAY) AS test_end
        FROM s)"""


@query("i1_fold_table", f"WITH {_FOLDS_SQL} SELECT * FROM f")
def q_folds(spark, sf_dir):
    """Walk-forward fold table (15-day test blocks, 730-day training windows)."""
    return _folds(spark, Tables(spark, sf_dir))


@query("c10_fold_membership", f"""
WITH d AS ({SQL_ORDER_DAILY}), {_FOLDS_SQL}
SELECT d.series_id, f.fold_id, count(*) FILTER (WHERE d.ts < f.cal_start) AS n_train,
       count(*) FILTER (WHERE d.ts >= f.cal_start AND d.ts < f.test_start) AS n_cal,
       count(*) FILTER (WHERE d.ts >= f.test_start) AS n_test
FROM d JOIN f ON d.ts >= f.train_start AND d.ts < f.test_end GROUP BY 1, 2""")
def q_membership(spark, sf_dir):
    """Rows per fold and role, from per-day counts ⋈ broadcast fold table."""
    t = Tables(spark, sf_dir)
    return fold_row_counts(order_daily(t), _folds(spark, t), "ts", ["series_id"])


@query("i9_chronological_split", f"""
WITH d AS ({SQL_ORDER_DAILY})
SELECT series_id, CASE WHEN ts < TIMESTAMP '{TEST0}' THEN 'train' ELSE 'test' END AS part, count(*) AS rows,
       min(ts) AS first_ts, max(ts) AS last_ts FROM d GROUP BY 1, 2""")
def q_split(spark, sf_dir):
    """Single chronological split; row counts and ranges of each side."""
    d = order_daily(Tables(spark, sf_dir))
    tr, te = chronological_split(d, "ts", TEST0)
    agg = [F.count(F.lit(1)).alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")]
    return (tr.groupBy("series_id").agg(*agg).withColumn("part", F.lit("train"))
            .unionByName(te.groupBy("series_id").agg(*agg).withColumn("part", F.lit("test"))))


# daily modelling table: target + positional lags/rolls + calendar, on orders per priority
_DLAGS = (1, 7, 14, 28)
_DROLLS = {"roll7_mean": (7, 1, 4), "roll28_mean": (28, 1, 14)}
DAILY_FEATURES = [f"lag{k}" for k in _DLAGS] + list(_DROLLS) + ["sindow", "cosdow", "sin_doy", "cos_doy"]


def daily_features(daily):
    """The modelling table of daily series ``(series_id, ts, value)``."""
    spec = Lookback()
    for k in _DLAGS:
        spec.lag(f"lag{k}", "value", k)
    for n, (lo, hi, mp) in _DROLLS.items():
        spec.rolling_mean(n, "value", lo, hi, mp)
    d = with_position(daily, ["series_id"], "ts", "rows", out="_p")
    f = lookback_features(d, ["series_id"], "_p", spec).drop("_p")
    dow, doy = F.weekday("ts"), F.dayofyear("ts")
    return f.select("series_id", "ts", F.col("value").alias("y"), *[F.col(c) for c in DAILY_FEATURES[:6]],
                    F.sin(2 * F.pi() * dow / 7).alias("sindow"), F.cos(2 * F.pi() * dow / 7).alias("cosdow"),
                    F.sin(2 * F.pi() * doy / 365.25).alias("sin_doy"), F.cos(2 * F.pi() * doy / 365.25).alias("cos_doy"))


@query("i2_gram_by_year", f"""
WITH d AS ({SQL_ORDER_DAILY}),
l AS (SELECT series_id, year(ts) AS seg, value / 10000 AS y, lag(value, 1) OVER w / 10000 AS x0,
             lag(value, 7) OVER w / 10000 AS x1
      FROM d WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
c AS (SELECT * FROM l WHERE x0 IS NOT NULL AND x1 IS NOT NULL)
SELECT series_id, seg, count(*) AS n, sum(y) AS sy, sum(y * y) AS syy, sum(x0) AS sx0, sum(x1) AS sx1,
       sum(x0 * y) AS sxy0, sum(x1 * y) AS sxy1, sum(x0 * x0) AS sxx00, sum(x0 * x1) AS sxx01, sum(x1 * x1) AS sxx11
FROM c GROUP BY 1, 2""", doubles=["sy", "syy", "sx0", "sx1", "sxy0", "sxy1", "sxx00", "sxx01", "sxx11"], ints=["seg"])
def q_gram(spark, sf_dir):
    """Gram sufficient statistics per (series, segment) in one aggregation."""
    f = daily_features(order_daily(Tables(spark, sf_dir))).dropna(subset=["lag1", "lag7"])
    f = f.select("series_id", "ts", *[(F.col(c) / 10000).alias(c) for c in ("y", "lag1", "lag7")])  # units of 10⁴
    g = gram_table(f.withColumn("seg", F.year("ts")), ["series_id", "seg"], ["lag1", "lag7"], "y")
    return g.select("series_id", "seg", "n", "sy", "syy", F.col("sx")[0].alias("sx0"), F.col("sx")[1].alias("sx1"),
                    F.col("sxy")[0].alias("sxy0"), F.col("sxy")[1].alias("sxy1"), F.col("sxx")[0].alias("sxx00"),
                    F.col("sxx")[1].alias("sxx01"), F.col("sxx")[2].alias("sxx11"))


@query("i2_gram_walk_forward")
def q_gram_walk(spark, sf_dir):
    """Walk-forward of the linear models from Gram tables alone, the way for windows that no task can hold:
    test MAE, mean training MAE and overfit ratio on the daily series (ridge by GCV)."""
    t = Tables(spark, sf_dir)
    p, _, tm = walk_forward_linear(daily_features(order_daily(t)), _folds(spark, t), series=["series_id"], ts="ts", y="y",
                                   features=DAILY_FEATURES, models=("ridge", "lasso", "elasticnet"), min_train=300)
    m = p.groupBy("series_id", "model").agg(F.count(F.lit(1)).alias("n"),
                                            F.avg(F.abs(F.col("yhat") - F.col("y"))).alias("test_mae"))
    return m.join(tm, ["series_id", "model"]).withColumn("overfit", F.try_divide("test_mae", "train_mae"))


@query("i22_conformal_pass", f"""
WITH {SQL_PRED},
q AS (SELECT series_id, model, ts, y, yhat, y - yhat AS r,
             hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia') AS hour,
             CASE WHEN ts < TIMESTAMP '2024-01-20 00:00:00' THEN 'cal' ELSE 'test' END AS part FROM p),
r AS (SELECT series_id, model, hour, abs(r) AS a FROM q WHERE part = 'cal'),
kc AS (SELECT *, row_number() OVER (PARTITION BY series_id, model, hour ORDER BY a) AS rn,
              count(*) OVER (PARTITION BY series_id, model, hour) AS m FROM r),
qc AS (SELECT series_id, model, hour, a AS w FROM kc WHERE rn = least(ceil((m + 1) * 0.9), m)),
kg AS (SELECT *, row_number() OVER (PARTITION BY series_id, model ORDER BY a) AS rn,
              count(*) OVER (PARTITION BY series_id, model) AS m FROM r),
qg AS (SELECT series_id, model, a AS w FROM kg WHERE rn = least(ceil((m + 1) * 0.9), m)),
t AS (SELECT q.series_id, q.model, q.y, q.yhat, coalesce(qc.w, qg.w) AS w FROM q
      JOIN qg USING (series_id, model) LEFT JOIN qc USING (series_id, model, hour) WHERE part = 'test'),
iv AS (SELECT series_id, model, y, yhat - w AS lo, yhat + w AS hi, w FROM t)
SELECT series_id, model, count(*) AS n, avg(CASE WHEN y >= lo AND y <= hi THEN 1.0 ELSE 0.0 END) * 100 AS coverage_pct,
       avg(w) AS mean_half_width,
       avg(hi - lo + CASE WHEN y < lo THEN 20 * (lo - y) ELSE 0 END + CASE WHEN y > hi THEN 20 * (y - hi) ELSE 0 END)
         AS winkler
FROM iv GROUP BY 1, 2""", doubles=["coverage_pct", "mean_half_width", "winkler"])
def q_conformal_pass(spark, sf_dir):
    """Split-conformal pass: Mondrian widths from a calibration window, intervals on the test window."""
    p = cut_lineage(predictions(Tables(spark, sf_dir)).withColumn("r", F.col("y") - F.col("yhat")).withColumn(
        "hour", F.hour(F.from_utc_timestamp("ts", "Europe/Sofia"))))  # written once: calibration and test rows
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp")
    w = mondrian_widths(p.filter(F.col("ts") < cut), ["series_id", "model"], "hour", "r", 0.10)
    te = p.filter(F.col("ts") >= cut).join(w, ["series_id", "model", "hour"])
    iv = te.select("series_id", "model", "y", (F.col("yhat") - F.col("w")).alias("lo"),
                   (F.col("yhat") + F.col("w")).alias("hi"))
    return interval_quality(iv, ["series_id", "model"], "y", "lo", "hi", 0.10)


@query("i25_quarter_hour_ramp", f"""
WITH {SQL_PRED},
w AS (SELECT series_id, model, ts, lag(y) OVER (PARTITION BY series_id, model ORDER BY ts) AS a, yhat AS f FROM p),
e AS (SELECT series_id, model, ts AS src, a, f, unnest(range(1, 5)) AS q FROM w),
r AS (SELECT series_id, model, src - (4 - q) * INTERVAL 15 MINUTE AS ts, src, a + (q / 4.0) * (f - a) AS p15 FROM e)
SELECT series_id, model, ts, p15 FROM (SELECT *, row_number() OVER (PARTITION BY series_id, model, ts ORDER BY src DESC) AS rn
  FROM r WHERE p15 IS NOT NULL) WHERE rn = 1""", doubles=["p15"])
def q_ramp(spark, sf_dir):
    """Linear 15-minute ramp from the last known value (lag 1, not the target hour's own) to each model's hourly forecast."""
    p = predictions(Tables(spark, sf_dir))
    known = lag_columns(p.select("series_id", "model", "ts", "y", F.col("yhat").alias("f")), ["series_id", "model"], "ts", "y", [1])
    return linear_ramp(known, ["series_id", "model"], "ts", "lag1", "f")


# --- I27 feature tables on the hourly event series -----------------------------------

_LOAD_SQL = "SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, sum(value) AS load FROM events GROUP BY 1, 2"
_MASTER_SQL = ("SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, avg(value) / 10 - 5 AS temp_c, "
               "CAST(count(*) AS DOUBLE) AS wind10_ms, max(value) / 10 AS wind100_ms, sum(value) AS ghi_wm2, "
               "min(value) AS dni_wm2, stddev_samp(value) AS cloud_pct, avg(value) - min(value) AS precip_mm, "
               "max(value) - min(value) AS rh_pct FROM events GROUP BY 1, 2")
_FEAT_DATES = ("seen AS (SELECT CAST((date_trunc('hour', ts) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE) AS d "
               "FROM events), dates AS (SELECT CAST(unnest(generate_series(CAST(min(d) AS TIMESTAMP) - INTERVAL 1 DAY, "
               "CAST(max(d) AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM seen)")


def hourly_inputs(spark, t):
    ev = t("events", "event_type", "ts", "value")
    g = ev.groupBy(F.col("event_type").alias("series_id"), F.date_trunc("hour", "ts").alias("ts"))
    load = g.agg(F.sum("value").alias("load"))
    v = F.col("value")
    master = g.agg((F.avg(v) / 10 - 5).alias("temp_c"), F.count(F.lit(1)).cast("double").alias("wind10_ms"),
                   (F.max(v) / 10).alias("wind100_ms"), F.sum(v).alias("ghi_wm2"), F.min(v).alias("dni_wm2"),
                   F.stddev_samp(v).alias("cloud_pct"), (F.avg(v) - F.min(v)).alias("precip_mm"),
                   (F.max(v) - F.min(v)).alias("rh_pct"))
    # every day of the span and its neighbours: a day off counts where no row lies on it, too
    day = F.to_date(F.from_utc_timestamp(F.date_trunc("hour", "ts"), "Europe/Sofia"))
    dates = ev.agg(F.min(day).alias("a"), F.max(day).alias("b")).where("a is not null").select(
        F.explode(F.sequence(F.date_sub("a", 1), F.date_add("b", 1))).alias("date"))
    return load, master, cut_lineage(days_off_from_dates(spark, dates))  # a calendar, made once


def _feature_query(name):
    h = HORIZONS[name]
    sql = features_sql(h, _LOAD_SQL, _MASTER_SQL, f"WITH {_FEAT_DATES}, {SQL_HOLIDAYS}")

    @query(f"i27_features_{name}", sql, doubles=["load_actual_mw", *feature_columns(h)])
    def q(spark, sf_dir):
        load, master, off = hourly_inputs(spark, Tables(spark, sf_dir))
        return build_features(h, load, master, off)

    q.__doc__ = f"I27: {name} horizon feature table ({len(feature_columns(h))} predictors)."
    return q


for _h in HORIZONS:
    _feature_query(_h)


_H8_COLS = feature_columns(HORIZONS["1d"])
_H8_SQL = features_sql(HORIZONS["1d"], _LOAD_SQL, _MASTER_SQL, f"WITH {_FEAT_DATES}, {SQL_HOLIDAYS}")


@query("h8_feature_blocks", f"""
WITH t AS ({_H8_SQL}),
c AS (SELECT {", ".join(f"count({c}) AS {c}" for c in _H8_COLS)} FROM t)
SELECT feature, CASE WHEN regexp_matches(feature, '^(lag|roll|diff)') THEN 'LOAD'
    WHEN regexp_matches(feature, '^(sin|cos|is_|hol|pre_|post_|bridge)') THEN 'CAL' ELSE 'WX' END AS block, n
FROM (UNPIVOT c ON {", ".join(_H8_COLS)} INTO NAME feature VALUE n)""")
def q_blocks(spark, sf_dir):
    """H8: the block of each day-ahead predictor by its prefix, and how many rows have it."""
    f = build_features(HORIZONS["1d"], *hourly_inputs(spark, Tables(spark, sf_dir)))
    counts = f.agg(*[F.count(c).alias(c) for c in _H8_COLS]).unpivot([], _H8_COLS, "feature", "n")
    return counts.select("feature", feature_block(F.col("feature")).alias("block"), "n")
