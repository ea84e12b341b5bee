"""Group E and F queries: lags, rolling frames, conformal widths, scores, ranking."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.aggregates import correlations, daily_peak, forecast_metrics
from ..operators.windows import Lookback, lookback_features, prefix_sums, time_position, with_position
from .evaluate import composite_selection, conformal_quantile, minmax_lower_better, mondrian_widths, naive_last_value
from .inputs import SQL_EVENT_GRID, SQL_EVENT_HOURLY, SQL_ORDER_DAILY, event_grid, event_hourly, order_daily
from .q_aggs import CUT, MODELS, SQL_PRED, predictions, wide_predictions
from .registry import Tables, query

_LAGS = [1, 2, 3, 24, 48, 168]
_W = "OVER (PARTITION BY series_id ORDER BY ts)"


def _daily_features(t, spec):
    d = with_position(order_daily(t), ["series_id"], "ts", "rows", out="_p")
    return lookback_features(d, ["series_id"], "_p", spec).drop("_p")


@query("e1_positional_lags", f"""
WITH d AS ({SQL_ORDER_DAILY})
SELECT series_id, ts, value, {", ".join(f"lag(value, {k}) {_W} AS lag{k}" for k in _LAGS)} FROM d""",
       doubles=["value"] + [f"lag{k}" for k in _LAGS])
def q_lags(spark, sf_dir):
    """Positional lags (k rows back, pandas ``shift`` parity) on gapped daily series."""
    spec = Lookback()
    for k in _LAGS:
        spec.lag(f"lag{k}", "value", k)
    return _daily_features(Tables(spark, sf_dir), spec)


@query("e1_time_lags", f"""
WITH h AS ({SQL_EVENT_HOURLY})
SELECT h.series_id, h.ts, h.value, p.value AS lag24 FROM h LEFT JOIN h p
  ON p.series_id = h.series_id AND p.ts = h.ts - INTERVAL 24 HOUR""", doubles=["value", "lag24"])
def q_time_lags(spark, sf_dir):
    """E1 (time mode): the value exactly 24 hours earlier, NULL when that hour is absent."""
    h = event_hourly(Tables(spark, sf_dir)).withColumn("_p", time_position("ts", 3600))
    return lookback_features(h, ["series_id"], "_p", Lookback().lag("lag24", "value", 24)).drop("_p")


def _frame(lo, hi):
    return f"OVER (PARTITION BY series_id ORDER BY ts ROWS BETWEEN {lo} PRECEDING AND {hi} PRECEDING)"


_ROLLS = {"roll24_mean": (47, 24, 12), "roll168_mean": (191, 24, 84), "roll3_mean": (3, 1, 2)}


@query("e2_rolling_means", f"""
WITH d AS ({SQL_ORDER_DAILY})
SELECT series_id, ts, {", ".join(f"CASE WHEN count(value) {_frame(lo, hi)} >= {mp} THEN avg(value) {_frame(lo, hi)} END AS {n}"
                                for n, (lo, hi, mp) in _ROLLS.items())} FROM d""", doubles=list(_ROLLS))
def q_rolling(spark, sf_dir):
    """Rolling means over lagged frames with ``min_periods``."""
    spec = Lookback()
    for n, (lo, hi, mp) in _ROLLS.items():
        spec.rolling_mean(n, "value", lo, hi, mp)
    return _daily_features(Tables(spark, sf_dir), spec).drop("value")


@query("e3_lag_differences", f"""
WITH d AS ({SQL_ORDER_DAILY})
SELECT series_id, ts, lag(value, 24) {_W} - lag(value, 48) {_W} AS diff_24_48,
       lag(value, 24) {_W} - lag(value, 168) {_W} AS diff_24_168,
       lag(value, 1) {_W} - lag(value, 2) {_W} AS diff_1_2 FROM d""",
       doubles=["diff_24_48", "diff_24_168", "diff_1_2"])
def q_diffs(spark, sf_dir):
    """Differences of lags (24−48, 24−168, 1−2)."""
    spec = Lookback().lag_diff("diff_24_48", "value", 24, 48).lag_diff("diff_24_168", "value", 24, 168).lag_diff(
        "diff_1_2", "value", 1, 2)
    return _daily_features(Tables(spark, sf_dir), spec).drop("value")


@query("e4_lagged_exogenous", f"""
WITH {SQL_EVENT_GRID},
m AS (SELECT event_type AS series_id, date_trunc('hour', ts) AS ts, avg(value) AS exog FROM events GROUP BY 1, 2),
r AS (SELECT a.series_id, a.ts, a.value, m.exog FROM a JOIN m USING (series_id, ts) WHERE a.value IS NOT NULL)
SELECT series_id, ts, value, lag(exog, 168) {_W} AS exog_lag168 FROM r""", doubles=["value", "exog_lag168"])
def q_exog(spark, sf_dir):
    """Exogenous driver lagged 168 *master rows* (rows without the target are not rows)."""
    t = Tables(spark, sf_dir)
    g = event_grid(t).filter(F.col("value").isNotNull())
    m = event_hourly(t, "mean").withColumnRenamed("value", "exog")
    r = with_position(g.join(m, ["series_id", "ts"]), ["series_id"], "ts", "rows", out="_p")
    return lookback_features(r, ["series_id"], "_p", Lookback().lag("exog_lag168", "exog", 168)).drop("_p", "exog")


@query("e5_conformal_quantile", f"""
WITH {SQL_PRED},
r AS (SELECT series_id, model, abs(y - yhat) AS a FROM p),
k AS (SELECT series_id, model, a, row_number() OVER (PARTITION BY series_id, model ORDER BY a) AS rn,
             count(*) OVER (PARTITION BY series_id, model) AS m FROM r)
SELECT series_id, model, m, a AS q FROM k WHERE rn = least(ceil((m + 1) * 0.9), m)""", doubles=["q"])
def q_conformal(spark, sf_dir):
    """E5: discrete split-conformal quantile of |residual| per series and model (α = 0.10)."""
    p = predictions(Tables(spark, sf_dir))
    return conformal_quantile(p.withColumn("r", F.col("y") - F.col("yhat")), ["series_id", "model"], "r", 0.10)


@query("e6_mondrian_widths", f"""
WITH {SQL_PRED},
r AS (SELECT series_id, model, hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia') AS hour, abs(y - yhat) AS a
      FROM p),
kc AS (SELECT series_id, model, hour, a, row_number() OVER (PARTITION BY series_id, model, hour ORDER BY a) AS rn,
              count(*) OVER (PARTITION BY series_id, model, hour) AS m FROM r),
qc AS (SELECT series_id, model, hour, a AS q FROM kc WHERE rn = least(ceil((m + 1) * 0.9), m)),
kg AS (SELECT series_id, model, a, row_number() OVER (PARTITION BY series_id, model ORDER BY a) AS rn,
              count(*) OVER (PARTITION BY series_id, model) AS m FROM r),
qg AS (SELECT series_id, model, a AS q FROM kg WHERE rn = least(ceil((m + 1) * 0.9), m)),
hrs AS (SELECT unnest(range(24)) AS hour)
SELECT qg.series_id, qg.model, hrs.hour, coalesce(qc.q, qg.q) AS w
FROM qg CROSS JOIN hrs LEFT JOIN qc ON qc.series_id = qg.series_id AND qc.model = qg.model AND qc.hour = hrs.hour""",
       doubles=["w"], ints=["hour"])
def q_mondrian(spark, sf_dir):
    """Mondrian (per local hour) conformal widths per series and model, with global fallback."""
    p = predictions(Tables(spark, sf_dir))
    r = p.select("series_id", "model", F.hour(F.from_utc_timestamp("ts", "Europe/Sofia")).alias("hour"),
                 (F.col("y") - F.col("yhat")).alias("r"))
    return mondrian_widths(r, ["series_id", "model"], "hour", "r", 0.10)


_METRICS_SQL = f"""{SQL_PRED},
  mt AS (SELECT series_id, model, avg(abs(yhat - y) / y) * 100 AS mape, sqrt(avg((yhat - y) * (yhat - y))) AS rmse
         FROM p GROUP BY 1, 2)"""


def _metrics(t):
    return forecast_metrics(predictions(t), ["series_id", "model"], "y", "yhat", 0).select(
        "series_id", "model", "mape", "rmse")


@query("e7_minmax_score", f"""
WITH {_METRICS_SQL}
SELECT series_id, model, mape, CASE WHEN max(mape) OVER w - min(mape) OVER w > 0
  THEN (max(mape) OVER w - mape) / (max(mape) OVER w - min(mape) OVER w) ELSE 1.0 END AS s_mape
FROM mt WINDOW w AS (PARTITION BY series_id)""", doubles=["mape", "s_mape"])
def q_minmax(spark, sf_dir):
    """Lower-is-better min-max score across models (constant → 1)."""
    m = _metrics(Tables(spark, sf_dir))
    return m.select("series_id", "model", "mape", minmax_lower_better("mape", ["series_id"]).alias("s_mape"))


@query("e8_naive_last_train_value", f"""
WITH {SQL_EVENT_GRID},
l AS (SELECT series_id, arg_max(value, ts) AS yhat FROM a WHERE ts < TIMESTAMP '{CUT}' AND value IS NOT NULL
      GROUP BY 1)
SELECT a.series_id, a.ts, a.value AS y, l.yhat FROM a LEFT JOIN l USING (series_id)
WHERE a.ts >= TIMESTAMP '{CUT}'""", doubles=["y", "yhat"])
def q_naive_last(spark, sf_dir):
    """Last training value as a constant forecast for the test rows."""
    g = event_grid(Tables(spark, sf_dir))
    cut = F.lit(CUT).cast("timestamp")
    test = g.filter(F.col("ts") >= cut).withColumnRenamed("value", "y")
    return naive_last_value(g.filter(F.col("ts") < cut), test, ["series_id"], "ts", "value")


@query("e10_prefix_sums", f"""
WITH {SQL_EVENT_GRID}
SELECT series_id, ts, value, sum(value) OVER (PARTITION BY series_id ORDER BY ts
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_value FROM a""", doubles=["value", "cum_value"])
def q_prefix(spark, sf_dir):
    """Running sums per series (bucketed prefix sum with carry)."""
    g = event_grid(Tables(spark, sf_dir)).withColumn("_p", time_position("ts", 3600))
    return prefix_sums(g, ["series_id"], "_p", ["value"]).drop("_p")


# --- F: sorts, ranking, top-1 -----------------------------------------------------

@query("f1_sorted_output", f"WITH {SQL_EVENT_GRID} SELECT * FROM a ORDER BY series_id, ts", doubles=["value"])
def q_sorted(spark, sf_dir):
    """sort by (series, ts) only at the sink."""
    return event_grid(Tables(spark, sf_dir)).orderBy("series_id", "ts")


@query("f2_rank_features", f"""
WITH {SQL_PRED},
cr AS (SELECT 'naive24' AS feature, corr(naive24, value) AS corr FROM c
       UNION ALL SELECT 'naive168', corr(naive168, value) FROM c UNION ALL SELECT 'mean24', corr(mean24, value) FROM c)
SELECT feature, corr, row_number() OVER (ORDER BY abs(corr) DESC, feature) AS rank FROM cr""", doubles=["corr"])
def q_rank(spark, sf_dir):
    """features ranked by |corr| with the target (a handful of rows)."""
    c = correlations(wide_predictions(Tables(spark, sf_dir)), "y", MODELS)
    return c.withColumn("rank", F.row_number().over(Window.orderBy(F.abs("corr").desc(), "feature")))


@query("f3_argmax_model", f"""
WITH {_METRICS_SQL},
s AS (SELECT *, CASE WHEN max(mape) OVER w - min(mape) OVER w > 0
                     THEN (max(mape) OVER w - mape) / (max(mape) OVER w - min(mape) OVER w) ELSE 1.0 END AS s_mape,
                CASE WHEN max(rmse) OVER w - min(rmse) OVER w > 0
                     THEN (max(rmse) OVER w - rmse) / (max(rmse) OVER w - min(rmse) OVER w) ELSE 1.0 END AS s_rmse
      FROM mt WINDOW w AS (PARTITION BY series_id)),
r AS (SELECT *, (s_mape + s_rmse) / 2 AS score FROM s)
SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY score DESC,
          list_position({MODELS!r}, model)) AS rank,
       row_number() OVER (PARTITION BY series_id ORDER BY score DESC, list_position({MODELS!r}, model)) = 1 AS selected
FROM r""", doubles=["mape", "rmse", "s_mape", "s_rmse", "score"])
def q_argmax(spark, sf_dir):
    """Composite min-max score per model; argmax with model-order tiebreak."""
    return composite_selection(_metrics(Tables(spark, sf_dir)), ["series_id"], "model", ["mape", "rmse"], MODELS)


@query("f4_daily_peak_rows", f"""
WITH {SQL_EVENT_GRID},
k AS (SELECT *, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE) AS local_date FROM a
      WHERE value IS NOT NULL)
SELECT series_id, ts, value, local_date FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id, local_date ORDER BY value DESC, ts) AS rn FROM k) WHERE rn = 1""",
       doubles=["value"], dates=["local_date"])
def q_peak_rows(spark, sf_dir):
    """per series and local day, the peak hour (earliest on ties)."""
    g = event_grid(Tables(spark, sf_dir)).filter(F.col("value").isNotNull())
    return daily_peak(g, ["series_id"], "ts", "value")


@query("f5_date_window_slice", f"""
WITH {SQL_EVENT_GRID} SELECT * FROM a
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-12 00:00:00'""", doubles=["value"])
def q_slice(spark, sf_dir):
    """a date-window zoom (filter pushed to the grid)."""
    g = event_grid(Tables(spark, sf_dir))
    return g.filter((F.col("ts") >= F.lit("2024-01-10 00:00:00").cast("timestamp"))
                    & (F.col("ts") < F.lit("2024-01-12 00:00:00").cast("timestamp")))
