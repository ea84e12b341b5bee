"""Group D queries: row-wise sums, cross-location means, direction means, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import (correlation_matrix, correlations, cross_mean, daily_peak, density_histogram,
                                    distribution_summary, event_loss, forecast_metrics, interval_quality, line_fit,
                                    peak_metrics, row_sum_zero, skill_vs_benchmark, standardize,
                                    standardize_stats, standardized_metrics, vector_mean_direction)
from ..operators.joins import asof_year, interval_coverage
from .evaluate import naive_predictions
from .inputs import SQL_EVENT_GRID, SQL_EVENT_HOURLY, SQL_INTERVALS, event_grid, event_hourly, order_intervals
from .registry import Tables, query

MODELS = ["naive24", "naive168", "mean24"]
CUT = "2024-01-16 00:00:00"

# SQL twin of naive_predictions(event_grid): wide ``c`` (complete rows) and long ``p``.
SQL_PRED = f"""{SQL_EVENT_GRID},
  l AS (SELECT *, lag(value, 24) OVER (PARTITION BY series_id ORDER BY ts) AS naive24,
               lag(value, 168) OVER (PARTITION BY series_id ORDER BY ts) AS naive168,
               CASE WHEN count(value) OVER (PARTITION BY series_id ORDER BY ts
                                            ROWS BETWEEN 47 PRECEDING AND 24 PRECEDING) >= 12
                    THEN avg(value) OVER (PARTITION BY series_id ORDER BY ts
                                          ROWS BETWEEN 47 PRECEDING AND 24 PRECEDING) END AS mean24
        FROM a),
  c AS (SELECT * FROM l WHERE value IS NOT NULL AND naive24 IS NOT NULL AND naive168 IS NOT NULL
                              AND mean24 IS NOT NULL),
  p AS (SELECT series_id, ts, value AS y, 'naive24' AS model, naive24 AS yhat FROM c
        UNION ALL SELECT series_id, ts, value, 'naive168', naive168 FROM c
        UNION ALL SELECT series_id, ts, value, 'mean24', mean24 FROM c)"""


def predictions(t):
    return naive_predictions(event_grid(t))


def wide_predictions(t):
    return predictions(t).groupBy("series_id", "ts", "y").pivot("model", MODELS).agg(F.first("yhat"))


_NET = "purchase"
_GEN = ["click", "error", "signup", "view"]


@query("d1_row_sum_supply", f"""
WITH w AS (SELECT date_trunc('hour', ts) AS ts,
  {", ".join(f"sum(value) FILTER (WHERE event_type = '{e}') AS {e}" for e in _GEN + [_NET])}
  FROM events GROUP BY 1)
SELECT ts, {" + ".join(f"coalesce({e}, 0)" for e in _GEN)} + {_NET} AS supply FROM w""", doubles=["supply"])
def q_rowsum(spark, sf_dir):
    """supply = Σ types (missing = 0) + net position (NULL stays NULL)."""
    ev = Tables(spark, sf_dir)("events", "event_type", "ts", "value")
    w = ev.groupBy(F.date_trunc("hour", "ts").alias("ts")).pivot("event_type", _GEN + [_NET]).agg(F.sum("value"))
    return w.select("ts", row_sum_zero(_GEN, plus=_NET).alias("supply"))


@query("d2_cross_location_mean", f"WITH h AS ({SQL_EVENT_HOURLY}) SELECT ts, avg(value) AS value FROM h GROUP BY ts",
       doubles=["value"])
def q_crossmean(spark, sf_dir):
    """Mean across locations (series) per hour, missing skipped."""
    return cross_mean(event_hourly(Tables(spark, sf_dir)), ["ts"], "value")


_LOC_SQL = """loc AS (SELECT event_type, date_trunc('hour', ts) AS ts, avg(value) / 10 AS s,
                  ((sum(value) * 10) % 360 + 360) % 360 AS d FROM events GROUP BY 1, 2)"""


def _locations(t):
    ev = t("events", "event_type", "ts", "value")
    return ev.groupBy("event_type", F.date_trunc("hour", "ts").alias("ts")).agg(
        (F.avg("value") / 10).alias("s"), F.pmod(F.sum("value") * 10, F.lit(360.0)).alias("d"))


@query("d3_vector_mean_direction", f"""
WITH {_LOC_SQL},
v AS (SELECT ts, avg(s * sin(radians(d))) AS ss, avg(s * cos(radians(d))) AS cc, count(*) AS n FROM loc GROUP BY ts)
SELECT ts, CASE WHEN n >= 5 THEN ((degrees(atan2(ss, cc)) % 360) + 360) % 360 END AS direction FROM v""",
       doubles=["direction"])
def q_vector(spark, sf_dir):
    """D3: speed-weighted vector-mean direction over five locations, strict (any missing → NULL)."""
    return vector_mean_direction(_locations(Tables(spark, sf_dir)), ["ts"], "d", "s", n_locations=5)


@query("d4_circular_mean", f"""
WITH {_LOC_SQL},
v AS (SELECT ts, avg(sin(radians(d))) AS ss, avg(cos(radians(d))) AS cc FROM loc GROUP BY ts)
SELECT ts, ((degrees(atan2(ss, cc)) % 360) + 360) % 360 AS direction FROM v""", doubles=["direction"])
def q_circular(spark, sf_dir):
    """Circular mean of directions (unit weights), missing skipped."""
    return vector_mean_direction(_locations(Tables(spark, sf_dir)), ["ts"], "d", None)


@query("d5_forecast_metrics", f"""
WITH {SQL_PRED}
SELECT series_id, model, count(*) AS n, avg(abs(yhat - y)) AS mae, sqrt(avg((yhat - y) * (yhat - y))) AS rmse,
       avg(abs(yhat - y) / y) * 100 AS mape, 1 - sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(*)) AS r2,
       1 - (sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(*))) * (count(*) - 1) / (count(*) - 0 - 1) AS adj_r2,
       avg(yhat - y) AS bias
FROM p GROUP BY 1, 2""", doubles=["mae", "rmse", "mape", "r2", "adj_r2", "bias"])
def q_metrics(spark, sf_dir):
    """MAE, RMSE, MAPE %, R², adjusted R², bias per series and model."""
    return forecast_metrics(predictions(Tables(spark, sf_dir)), ["series_id", "model"], "y", "yhat", 0)


@query("d6_standardized_metrics", f"""
WITH {SQL_PRED}
SELECT series_id, model, avg((yhat - y) * (yhat - y)) AS mse, sqrt(avg((yhat - y) * (yhat - y))) AS rmse,
       avg(abs(yhat - y)) AS mae, avg(abs(yhat - y) / abs(y)) AS mape FROM p GROUP BY 1, 2""",
       doubles=["mse", "rmse", "mae", "mape"])
def q_std_metrics(spark, sf_dir):
    """MSE / RMSE / MAE / MAPE-as-fraction per series and model."""
    return standardized_metrics(predictions(Tables(spark, sf_dir)), ["series_id", "model"])


@query("d7_skill_overfit", f"""
WITH {SQL_PRED},
m AS (SELECT series_id, model, avg(abs(yhat - y)) FILTER (WHERE ts >= TIMESTAMP '{CUT}') AS test_mae,
             avg(abs(yhat - y)) FILTER (WHERE ts < TIMESTAMP '{CUT}') AS train_mae FROM p GROUP BY 1, 2)
SELECT m.series_id, m.model, m.test_mae, m.train_mae, m.test_mae / m.train_mae AS overfit,
       (b.test_mae - m.test_mae) / b.test_mae * 100 AS skill_vs_naive24
FROM m LEFT JOIN m b ON b.series_id = m.series_id AND b.model = 'naive24'""",
       doubles=["test_mae", "train_mae", "overfit", "skill_vs_naive24"])
def q_skill(spark, sf_dir):
    """Skill vs the lag-24 benchmark and overfit ratio test MAE / train MAE."""
    p = predictions(Tables(spark, sf_dir))
    cut = F.lit(CUT).cast("timestamp")
    e = F.abs(F.col("yhat") - F.col("y"))
    m = p.groupBy("series_id", "model").agg(F.avg(F.when(F.col("ts") >= cut, e)).alias("test_mae"),
                                            F.avg(F.when(F.col("ts") < cut, e)).alias("train_mae"))
    m = m.withColumn("overfit", F.col("test_mae") / F.col("train_mae"))
    return skill_vs_benchmark(m, ["series_id"], "model", "naive24", "test_mae", "skill_vs_naive24")


@query("d8_daily_peak_metrics", f"""
WITH {SQL_PRED},
k AS (SELECT *, row_number() OVER (PARTITION BY series_id, model,
        CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia' AS DATE) ORDER BY y DESC, ts) AS rn FROM p)
SELECT series_id, model, count(*) AS days, avg(abs(yhat - y)) AS peak_mae, avg(abs(yhat - y) / y) * 100 AS peak_mape
FROM k WHERE rn = 1 GROUP BY 1, 2""", doubles=["peak_mae", "peak_mape"])
def q_peak(spark, sf_dir):
    """Errors at each local day's peak hour (earliest on ties)."""
    return peak_metrics(predictions(Tables(spark, sf_dir)), ["series_id", "model"], "ts", "y", "yhat")


@query("d9_correlation_with_target", f"""
WITH {SQL_PRED}
SELECT 'naive24' AS feature, corr(naive24, value) AS corr FROM c
UNION ALL SELECT 'naive168', corr(naive168, value) FROM c
UNION ALL SELECT 'mean24', corr(mean24, value) FROM c""", doubles=["corr"])
def q_corr(spark, sf_dir):
    """Pearson correlation of each feature with the target."""
    return correlations(wide_predictions(Tables(spark, sf_dir)), "y", MODELS)


@query("d9_correlation_matrix", f"""
WITH {SQL_PRED}
SELECT a, b, CASE {" ".join(f"WHEN a = '{x}' AND b = '{y}' THEN corr_{x}_{y}" for x in MODELS for y in MODELS)} END AS corr
FROM (SELECT {", ".join(f"corr({x}, {y}) AS corr_{x}_{y}" for x in MODELS for y in MODELS)} FROM c),
     (SELECT unnest({MODELS!r}) AS a), (SELECT unnest({MODELS!r}) AS b)""", doubles=["corr"])
def q_corrmat(spark, sf_dir):
    """Feature × feature correlation matrix (long form)."""
    return correlation_matrix(wide_predictions(Tables(spark, sf_dir)), MODELS)


@query("d10_standardize_train_stats", f"""
WITH {SQL_PRED},
s AS (SELECT {", ".join(f"avg({m}) AS {m}_m, stddev_pop({m}) AS {m}_s" for m in MODELS)}
      FROM c WHERE ts < TIMESTAMP '{CUT}')
SELECT series_id, ts, {", ".join(f"({m} - {m}_m) / {m}_s AS {m}" for m in MODELS)} FROM c, s""", doubles=MODELS)
def q_standardize(spark, sf_dir):
    """Z-scores with mean/std (ddof 0) fitted on the training rows only."""
    w = wide_predictions(Tables(spark, sf_dir))
    stats = standardize_stats(w.filter(F.col("ts") < F.lit(CUT).cast("timestamp")), MODELS, ddof=0)
    return standardize(w.select("series_id", "ts", *MODELS), MODELS, stats)


@query("d11_interval_quality", f"""
WITH {SQL_PRED},
i AS (SELECT series_id, value AS y, mean24 - abs(naive24 - naive168) / 2 AS lo,
             mean24 + abs(naive24 - naive168) / 2 AS hi FROM c)
SELECT series_id, count(*) AS n, avg(CASE WHEN y >= lo AND y <= hi THEN 1.0 ELSE 0.0 END) * 100 AS coverage_pct,
       avg((hi - lo) / 2) AS mean_half_width,
       avg(hi - lo + CASE WHEN y < lo THEN 20 * (lo - y) ELSE 0 END + CASE WHEN y > hi THEN 20 * (y - hi) ELSE 0 END)
         AS winkler
FROM i GROUP BY 1""", doubles=["coverage_pct", "mean_half_width", "winkler"])
def q_interval_quality(spark, sf_dir):
    """Coverage %, mean half-width and Winkler score (α = 0.10) of an interval forecast."""
    w = wide_predictions(Tables(spark, sf_dir))
    half = F.abs(F.col("naive24") - F.col("naive168")) / 2
    i = w.select("series_id", "y", (F.col("mean24") - half).alias("lo"), (F.col("mean24") + half).alias("hi"))
    return interval_quality(i, ["series_id"], "y", "lo", "hi", 0.10)


_COVER_SQL = f"""
  i AS ({SQL_INTERVALS}),
  b AS (SELECT min(start) AS s, max("end") AS e FROM i),
  g AS (SELECT unnest(generate_series(s, e, INTERVAL 1 DAY)) AS ts FROM b),
  t AS (SELECT DISTINCT plant_type AS category FROM i WHERE plant_type IS NOT NULL),
  cov AS (SELECT t.category, g.ts, count(i.start) AS active, coalesce(sum(i.mw), 0) AS total
          FROM g CROSS JOIN t LEFT JOIN i ON i.plant_type = t.category AND i.start <= g.ts AND g.ts < i."end"
          GROUP BY 1, 2)"""


def _coverage(t):
    return interval_coverage(order_intervals(t), category="plant_type", value="mw", closed=False,
                             step_seconds=86400)


@query("d12_outage_report", f"""
WITH {_COVER_SQL}
SELECT category, sum(CAST(total AS DECIMAL(38, 6))) * 24 AS mwh, max(total) AS peak_mw, max(total) = 0 AS untouched
FROM cov GROUP BY 1""",
       doubles=["mwh", "peak_mw"])
def q_outage(spark, sf_dir):
    """MW·h lost and peak MW by type (daily grid), with the untouched types."""
    c = _coverage(Tables(spark, sf_dir))
    exact = F.col("total").cast("decimal(38,6)")  # MW·h totals reach 1e13: keep the sum exact
    return c.groupBy("category").agg((F.sum(exact) * 24).alias("mwh"), F.max("total").alias("peak_mw"),
                                     (F.max("total") == 0).alias("untouched"))


@query("d13_distribution_summary", f"""
WITH {SQL_PRED},
e AS (SELECT series_id, model, y - yhat AS x FROM p),
m AS (SELECT series_id, model, avg(x) AS mu, count(x) AS n FROM e GROUP BY 1, 2),
k AS (SELECT e.series_id, e.model, n, mu, avg((x - mu) * (x - mu)) AS m2, avg(power(x - mu, 3)) AS m3,
             avg(power(x - mu, 4)) AS m4 FROM e JOIN m USING (series_id, model) GROUP BY 1, 2, 3, 4)
SELECT series_id, model, n, mu AS mean, sqrt(m2) AS std, m3 / power(m2, 1.5) AS skew, m4 / (m2 * m2) AS kurtosis
FROM k""", doubles=["mean", "std", "skew", "kurtosis"])
def q_distribution(spark, sf_dir):
    """Residual distribution: mean, std, skewness, kurtosis (normal = 3)."""
    p = predictions(Tables(spark, sf_dir)).withColumn("x", F.col("y") - F.col("yhat"))
    return distribution_summary(p, ["series_id", "model"], "x")


@query("d13_density_histogram", f"""
WITH {SQL_PRED},
e AS (SELECT series_id, model, y - yhat AS x FROM p),
bb AS (SELECT series_id, model, min(x) AS lo, max(x) AS hi, count(x) AS n FROM e GROUP BY 1, 2),
hh AS (SELECT series_id, model, lo, hi, n, least(floor((x - lo) / ((hi - lo) / 60)), 59) AS bin, count(*) AS count
      FROM e JOIN bb USING (series_id, model) GROUP BY ALL)
SELECT series_id, model, bin, lo + bin * (hi - lo) / 60 AS bin_left, count, count / (n * (hi - lo) / 60) AS density FROM hh""",
       doubles=["bin_left", "density"], ints=["bin"])
def q_histogram(spark, sf_dir):
    """60-bin density histogram of the residuals per series and model."""
    p = predictions(Tables(spark, sf_dir))
    return density_histogram(p.withColumn("x", F.col("y") - F.col("yhat")), ["series_id", "model"], "x", 60)


@query("d14_line_fit", f"""
WITH {SQL_PRED}
SELECT series_id, model, regr_slope(y, yhat) AS slope, regr_intercept(y, yhat) AS intercept FROM p GROUP BY 1, 2""",
       doubles=["slope", "intercept"])
def q_linefit(spark, sf_dir):
    """Slope and intercept of actual on predicted."""
    return line_fit(predictions(Tables(spark, sf_dir)), ["series_id", "model"], "y", "yhat")


@query("d15_available_capacity", f"""
WITH {_COVER_SQL},
np AS (SELECT l_returnflag AS category, year(l_shipdate) AS year, sum(l_extendedprice) / 50 AS nameplate
       FROM lineitem GROUP BY 1, 2 HAVING year(l_shipdate) <> 1997),
yr AS (SELECT DISTINCT category, year(ts) AS year FROM cov),
cap AS (SELECT yr.category, yr.year, coalesce(
          (SELECT nameplate FROM np WHERE np.category = yr.category AND np.year <= yr.year ORDER BY np.year DESC LIMIT 1),
          (SELECT nameplate FROM np WHERE np.category = yr.category AND np.year > yr.year ORDER BY np.year LIMIT 1))
          AS nameplate FROM yr)
SELECT cov.category, cov.ts, CASE WHEN cap.nameplate IS NOT NULL THEN greatest(cap.nameplate - cov.total, 0) END AS available
FROM cov JOIN cap ON cap.category = cov.category AND cap.year = year(cov.ts)""", doubles=["available"])
def q_available(spark, sf_dir):
    """Available capacity = max(nameplate (as-of yearly) − MW on outage, 0) per type and day."""
    t = Tables(spark, sf_dir)
    cov = _coverage(t)
    li = t("lineitem", "l_returnflag", "l_shipdate", "l_extendedprice")
    np_ = (li.groupBy(F.col("l_returnflag").alias("category"), F.year("l_shipdate").alias("year"))
           .agg((F.sum("l_extendedprice") / 50).alias("nameplate")).filter(F.col("year") != 1997))
    years = cov.select("category", F.year("ts").alias("year")).distinct()
    cap = asof_year(years, np_, "year", ["nameplate"], keys=["category"])
    j = cov.withColumn("year", F.year("ts")).join(cap, ["category", "year"])
    return j.select("category", "ts", F.when(F.col("nameplate").isNotNull(), F.greatest(
        F.col("nameplate") - F.col("total"), F.lit(0.0))).alias("available"))


@query("d16_event_loss", f"""
WITH i AS ({SQL_INTERVALS})
SELECT l_orderkey, l_linenumber, greatest(mw - coalesce(avail * 1500, 0), 0) AS loss FROM i
WHERE greatest(mw - coalesce(avail * 1500, 0), 0) > 0""", doubles=["loss"])
def q_loss(spark, sf_dir):
    """Per event MW lost = max(nominal − available, 0), kept when > 0."""
    i = order_intervals(Tables(spark, sf_dir)).withColumn("avail", F.col("avail") * 1500)
    return (i.select("l_orderkey", "l_linenumber", event_loss("mw", "avail").alias("loss"))
            .filter(F.col("loss") > 0))
