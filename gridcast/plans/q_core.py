"""Flagship slice: events → hourly grid → lags → seasonal-naive metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import forecast_metrics
from ..operators.windows import Lookback, lookback_features, time_position
from .inputs import SQL_EVENT_GRID, event_grid
from .registry import Tables, query

_NAIVE_SQL = f"""
WITH {SQL_EVENT_GRID},
  l AS (SELECT *, lag(value, 24) OVER w AS lag24, lag(value, 168) OVER w AS lag168
        FROM a WINDOW w AS (PARTITION BY series_id ORDER BY ts)),
  d AS (SELECT * FROM l WHERE value IS NOT NULL AND lag24 IS NOT NULL AND lag168 IS NOT NULL),
  p AS (SELECT series_id, 'naive24' AS model, value AS y, lag24 AS yhat FROM d
        UNION ALL SELECT series_id, 'naive168', value, lag168 FROM d)
SELECT series_id, model, count(*) AS n, avg(abs(yhat - y)) AS mae, sqrt(avg((yhat - y) * (yhat - y))) AS rmse,
       avg(abs(yhat - y) / y) * 100 AS mape,
       1 - sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(*)) AS r2,
       1 - (sum((yhat - y) * (yhat - y)) / (var_pop(y) * count(*))) * (count(*) - 1) / (count(*) - 0 - 1) AS adj_r2,
       avg(yhat - y) AS bias
FROM p GROUP BY 1, 2"""


def seasonal_naive_metrics(t: Tables):
    g = event_grid(t).withColumn("pos", time_position("ts", 3600))
    spec = Lookback().lag("lag24", "value", 24).lag("lag168", "value", 168)
    f = lookback_features(g, ["series_id"], "pos", spec)
    d = f.filter(F.col("value").isNotNull() & F.col("lag24").isNotNull() & F.col("lag168").isNotNull())
    p = (d.select("series_id", F.col("value").alias("y"), F.col("lag24").alias("naive24"),
                  F.col("lag168").alias("naive168"))
         .unpivot(["series_id", "y"], ["naive24", "naive168"], "model", "yhat"))
    return forecast_metrics(p, ["series_id", "model"], "y", "yhat", 0)


@query("e9_seasonal_naive_metrics", _NAIVE_SQL, doubles=["mae", "rmse", "mape", "r2", "adj_r2", "bias"])
def q_seasonal_naive(spark, sf_dir):
    """E9 + D5: lag-24 / lag-168 persistence forecasts scored per event type."""
    return seasonal_naive_metrics(Tables(spark, sf_dir))
