"""Gram solvers vs closed forms; conformal quantile; diagnostics helpers."""

import math

import numpy as np
from pyspark.sql import functions as F

from gridcast.plans.diagnostics import chi2_sf, mackinnon_p
from gridcast.plans.evaluate import conformal_quantile, mondrian_widths
from gridcast.plans.linear import Gram, _cd_batch, gram_table, lasso_path_lars, ridge_gcv


def test_gram_segments_sum_to_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i % 5), float(a), float(b), float(c)) for i, (a, b, c) in enumerate(rng.normal(size=(200, 3)))]
    df = spark.createDataFrame(rows, "seg int, x1 double, x2 double, y double")
    parts = gram_table(df, ["seg"], ["x1", "x2"], "y").toPandas()
    whole = gram_table(df.withColumn("k", F.lit(1)), ["k"], ["x1", "x2"], "y").toPandas()
    gp, gw = Gram.from_rows(parts, 2), Gram.from_rows(whole, 2)
    assert abs(gp.n - gw.n) < 1e-9 and np.allclose(gp.sxx, gw.sxx) and np.allclose(gp.sxy, gw.sxy)
    x = np.array([[r[1], r[2]] for r in rows])
    assert np.allclose(gw.sxx, x.T @ x)


def test_ridge_matches_closed_form():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 4))
    y = x @ np.array([1.0, -2.0, 0.5, 0.0]) + rng.normal(size=300)
    xc, yc = x - x.mean(0), y - y.mean()
    beta, a = ridge_gcv(xc.T @ xc, xc.T @ yc, yc @ yc, 300, alphas=(3.0,))
    assert np.allclose(beta, np.linalg.solve(xc.T @ xc + 3.0 * np.eye(4), xc.T @ yc))


def test_lasso_lars_equals_coordinate_descent():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6))
    x[:, 1] = x[:, 0] + 0.05 * rng.normal(size=400)
    y = x @ rng.normal(size=6) + rng.normal(size=400)
    xc, yc = x - x.mean(0), y - y.mean()
    g, c = xc.T @ xc, xc.T @ yc
    alphas = np.logspace(-3, 0, 15)[::-1] * np.max(np.abs(c)) / 400
    a = lasso_path_lars(g, c, 400, alphas)
    b = _cd_batch([g], [c], [400], [alphas], [1.0], tol=1e-12, max_iter=50000)[0]
    assert np.abs(a - b).max() < 1e-6


def test_conformal_quantile_and_fallback(spark):
    rows = [("g", h, float(r)) for h, r in [(0, 1), (0, -2), (0, 3), (0, 4), (0, 5), (1, 10)]]
    df = spark.createDataFrame(rows, "g string, hour int, r double")
    q = conformal_quantile(df.filter("hour = 0"), ["g"], "r", 0.10).first()
    assert q.m == 5 and q.q == 5.0  # k = min(ceil(6·0.9), 5) = 5 → 5th smallest |r|
    w = {r.hour: r.w for r in mondrian_widths(df, ["g"], "hour", "r", 0.10, cells=(0, 1, 2)).collect()}
    assert w[1] == 10.0 and w[2] == 10.0  # one residual → itself; empty hour → global (k = 6 → 10)


def test_distribution_helpers():
    assert abs(chi2_sf([3.841458820694124], 1)[0] - 0.05) < 1e-9
    assert abs(chi2_sf([5.991464547107979], 2)[0] - 0.05) < 1e-9
    assert abs(float(mackinnon_p(-2.8621)) - 0.05) < 0.01  # 5 % critical value with a constant
    assert math.isclose(float(mackinnon_p(5.0)), 1.0)
