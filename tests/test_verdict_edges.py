"""Edge cases: bounded interval grids, zero targets, own lags of each group, several buckets."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.operators.aggregates import forecast_metrics, standardized_metrics
from gridcast.operators.joins import interval_coverage
from gridcast.operators.windows import position_index
from gridcast.plans.diagnostics import adf_test, kpss_test


def ar1(n, phi, seed):
    e = np.random.default_rng(seed).normal(size=n)
    x = np.empty(n)
    x[0] = e[0]
    for i in range(1, n):
        x[i] = phi * x[i - 1] + e[i]
    return x


def frame(spark, series):
    rows = pd.concat([pd.DataFrame({"g": g, "i": np.arange(len(x)), "x": x}) for g, x in series.items()])
    return spark.createDataFrame(rows).withColumn("ts", F.timestamp_seconds(F.col("i") * 3600))


def plain_kpss(x):
    n, c = len(x), x - x.mean()
    ac = lambda k: float(c[k:] @ c[:n - k])
    head = int(n ** (2 / 9))
    s0 = ac(0) + 2 * sum(ac(k) for k in range(1, head + 1))
    s1 = 2 * sum(k * ac(k) for k in range(1, head + 1))
    lags = int(1.1447 * ((s1 / s0) ** 2 * n) ** (1 / 3))
    s2 = (ac(0) + 2 * sum((1 - k / (lags + 1)) * ac(k) for k in range(1, lags + 1))) / n
    return float((np.cumsum(c) ** 2).sum() / (n * n * s2)), lags


def test_kpss_bandwidth_follows_each_groups_n(spark):
    series = {"long": ar1(40_000, 0.995, 1), "short": ar1(300, 0.3, 2)}
    got = {r["g"]: r for r in kpss_test(frame(spark, series), ["g"], "ts", "x").collect()}
    for g, x in series.items():
        eta, lags = plain_kpss(x)
        assert got[g]["kpss_lags"] == lags and got[g]["kpss_stat"] == pytest.approx(eta, rel=1e-6)
    assert got["long"]["kpss_lags"] > 64


def plain_adf(x):
    most = min(math.ceil(12 * (len(x) / 100) ** 0.25), len(x) // 2 - 2)
    d = np.diff(x)

    def fit(lag, first):
        t = np.arange(first, len(d))
        cols = [np.ones(len(t)), x[t], *(d[t - k] for k in range(1, lag + 1))]
        m, y = np.column_stack(cols), d[t]
        b = np.linalg.lstsq(m, y, rcond=None)[0]
        ssr = float(((y - m @ b) ** 2).sum())
        return len(t), m, b, ssr

    def aic(lag):
        n, m, _, ssr = fit(lag, most)
        return n * (math.log(2 * math.pi) + math.log(ssr / n) + 1) + 2 * m.shape[1]

    lag = min(range(most + 1), key=aic)
    n, m, b, ssr = fit(lag, lag)
    return lag, float(b[1] / math.sqrt(ssr / (n - m.shape[1]) * np.linalg.inv(m.T @ m)[1, 1]))


def test_adf_lags_follow_each_groups_n(spark):
    series = {"a": ar1(700, 0.9, 3), "b": ar1(60, 0.2, 4)}
    got = {r["g"]: r for r in adf_test(frame(spark, series), ["g"], "ts", "x").collect()}
    for g, x in series.items():
        lag, stat = plain_adf(x)
        assert got[g]["used_lag"] == lag and got[g]["adf_stat"] == pytest.approx(stat, rel=1e-6)


def test_interval_begun_before_the_grid_counts_inside(spark):
    iv = spark.createDataFrame([("a", "2024-01-01 19:00:00", "2024-01-02 02:00:00", 10.0),
                                ("a", "2024-01-01 00:00:00", "2024-01-01 05:00:00", 7.0),
                                ("a", "2024-01-03 00:00:00", "2024-01-03 05:00:00", 7.0)],
                               "category string, start string, end string, mw double")
    iv = iv.withColumns({c: F.to_timestamp(c) for c in ("start", "end")})
    got = interval_coverage(iv, "2024-01-02 00:00:00", "2024-01-02 04:00:00", value="mw").orderBy("ts").collect()
    assert [r["active"] for r in got] == [1, 1, 1, 0, 0]
    assert [r["total"] for r in got] == [10.0, 10.0, 10.0, 0.0, 0.0]


def test_zero_targets_do_not_end_the_job(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 1.0), ("b", 0.0, 0.0)], "g string, y double, yhat double")
    got = {r["g"]: r for r in forecast_metrics(df, ["g"]).collect()}
    assert got["a"]["mape"] == 50.0 and got["b"]["mape"] is None and got["b"]["r2"] is None
    assert {r["g"]: r["mape"] for r in standardized_metrics(df, ["g"]).collect()} == {"a": 0.5, "b": None}


def test_positions_over_many_spans(spark):
    n = 3000
    df = spark.range(n).select(F.lit("s").alias("g"), F.timestamp_seconds(F.col("id") * 86400 * 40).alias("ts"), "id")
    assert position_index(df, ["g"], ["ts"]).where("pos <> id").count() == 0
