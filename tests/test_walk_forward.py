"""Walk-forward fits on bounded windows against plain versions."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.plans.boosting import Boosting, fit_boosted
from gridcast.plans.folds import fold_table
from gridcast.plans.linear import EN_L1_RATIOS, RIDGE_ALPHAS, _cd_batch, elastic_net_path, feature_sign
from gridcast.plans.walkforward import (conformal_pass, cross_validated, fit_model, fold_metrics, gram_of, predictions_of,
                                        ridge_loo, walk_forward)
from gridcast.session import cut_lineage


def sample(n=200, k=5, seed=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, k))
    x[:, 1] = x[:, 0] + 0.1 * x[:, 1]
    return x, x @ np.arange(k) + r.normal(size=n) * 2 + 7


def test_ridge_alpha_and_coefficients_equal_brute_force_leave_one_out():
    x, y = sample(60, 4)
    errors = []
    for a in RIDGE_ALPHAS:
        left = []
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            m, c = x[keep].mean(0), y[keep].mean()
            z = x[keep] - m
            b = np.linalg.solve(z.T @ z + a * np.eye(4), z.T @ (y[keep] - c))
            left.append(y[i] - c - (x[i] - m) @ b)
        errors.append(np.mean(np.square(left)))
    beta, b0, alpha, got = ridge_loo(x, y)
    # centring moves with the left-out row, so both forms are compared through the hat matrix of the intercept model
    np.testing.assert_allclose(got, errors, rtol=1e-8)
    assert alpha == RIDGE_ALPHAS[int(np.argmin(errors))]
    z = x - x.mean(0)
    np.testing.assert_allclose(beta, np.linalg.solve(z.T @ z + alpha * np.eye(4), z.T @ (y - y.mean())))
    assert b0 == pytest.approx(y.mean() - x.mean(0) @ beta)


@pytest.mark.parametrize("rho", EN_L1_RATIOS)
def test_elastic_net_path_equals_coordinate_descent(rho):
    x, y = sample(150, 8, 3)
    x = (x - x.mean(0)) / x.std(0)
    y = y - y.mean()
    alphas = np.logspace(1, -3, 25)
    want = _cd_batch([x.T @ x], [x.T @ y], [150], [alphas], [rho], tol=1e-12)[0]
    np.testing.assert_allclose(elastic_net_path(x.T @ x, x.T @ y, 150, alphas, rho), want, atol=1e-6)


def test_feature_sign_from_any_start_and_with_equal_columns():
    x, y = sample(100, 6, 5)
    x[:, 5] = x[:, 4]
    want = _cd_batch([x.T @ x], [x.T @ y], [100], [[0.3]], [0.5], tol=1e-13)[0, 0]
    for start in (np.zeros(6), np.full(6, -3.0), np.array([5.0, -5, 0, 1, -1, 9])):
        np.testing.assert_allclose(feature_sign(x.T @ x, x.T @ y, 15.0, 15.0, start), want, atol=1e-6)


def test_cross_validation_picks_the_alpha_of_brute_force():
    x, y = sample(103, 4, 8)
    x = (x - x.mean(0)) / x.std(0)
    beta, b0, alpha, rho = cross_validated(x, y, EN_L1_RATIOS, 4)
    size, best = 103 // 5, None
    for r in EN_L1_RATIOS:
        top = np.max(np.abs(x.T @ (y - y.mean()))) / (103 * r)
        alphas = np.logspace(np.log10(top), np.log10(top * 1e-3), 100)
        mse = np.zeros(100)
        for i in range(4):
            a = 103 - size * (4 - i)
            m, c = x[:a].mean(0), y[:a].mean()
            z = x[:a] - m
            path = _cd_batch([z.T @ z], [z.T @ (y[:a] - c)], [a], [alphas], [r], tol=1e-10)[0]
            mse += [np.mean((y[a:a + size] - c - (x[a:a + size] - m) @ b) ** 2) for b in path]
        if best is None or mse.min() < best[0]:
            best = (mse.min(), alphas[mse.argmin()], r)
    assert (alpha, rho) == (pytest.approx(best[1]), best[2])
    assert np.all(np.isfinite(beta)) and np.isfinite(b0)
    assert gram_of(x, y).n == 103


def plain_boosting(x, y, p):
    """Trees by recursion over rows, every cut between two values tried."""
    fitted = np.full(len(y), y.mean())

    def grow(rows, depth):
        g = fitted[rows] - y[rows]
        best = None
        if depth < p.depth:
            for j in range(x.shape[1]):
                for c in np.unique(x[rows, j])[:-1]:
                    left = x[rows, j] <= c
                    if min(left.sum(), (~left).sum()) < p.min_child:
                        continue
                    gl, gr = g[left].sum(), g[~left].sum()
                    gain = gl ** 2 / (left.sum() + p.l2) + gr ** 2 / ((~left).sum() + p.l2) - g.sum() ** 2 / (len(rows) + p.l2)
                    if gain >= p.gamma and (best is None or gain > best[0] + 1e-9):
                        best = (gain, j, c)
        if best is None:
            return {int(r): -p.rate * g.sum() / (len(rows) + p.l2) for r in rows}
        left = x[rows, best[1]] <= best[2]
        return grow(rows[left], depth + 1) | grow(rows[~left], depth + 1)

    for _ in range(p.rounds):
        step = grow(np.arange(len(y)), 0)
        fitted = fitted + np.array([step[i] for i in range(len(y))])
    return fitted


def test_boosting_equals_a_plain_booster():
    r = np.random.default_rng(1)
    x = r.integers(0, 40, size=(500, 4)).astype(float)
    y = np.where(x[:, 0] > 20, 5.0, 0) + x[:, 1] / 10 + r.normal(size=500)
    p = Boosting(rounds=15, rate=0.3, rows=1.1, columns=1.0)
    model, fitted = fit_boosted(x, y, p)
    np.testing.assert_allclose(fitted, plain_boosting(x, y, p), atol=1e-9)
    np.testing.assert_allclose(model.predict(x), fitted)
    assert model.importance().argmax() == 0 and model.importance().sum() == pytest.approx(1)


def test_boosting_learns_with_sampling_and_on_constants():
    x, y = sample(800, 5, 2)
    _, fitted = fit_boosted(x, y, Boosting(rounds=300, rate=0.1))
    assert np.mean((fitted - y) ** 2) < 0.35 * y.var()
    _, flat = fit_boosted(np.ones((50, 2)), np.full(50, 3.0), Boosting(rounds=3))
    np.testing.assert_allclose(flat, 3.0)


@pytest.fixture(scope="module")
def fits(spark):
    r = np.random.default_rng(4)
    n = 24 * 70
    t = pd.date_range("2024-01-01", periods=n, freq="h")
    frames = []
    for s in ("a", "b"):
        x = r.normal(size=(n, 3))
        frames.append(pd.DataFrame({"s": s, "ts": t, "y": x @ [1.0, 2, 0] + 5 + r.normal(size=n) * (1 + t.hour / 24),
                                    "f0": x[:, 0], "f1": x[:, 1], "f2": x[:, 2]}))
    data = pd.concat(frames)
    data.loc[data.index[10], "f0"] = None
    feat = spark.createDataFrame(data)
    folds = fold_table(spark, "2024-02-20", "2024-03-10 23:00:00", test_seconds=5 * 86400, train_seconds=30 * 86400,
                       cal_seconds=15 * 86400)
    out = cut_lineage(walk_forward(feat, folds, series=["s"], ts="ts", y="y", features=["f0", "f1", "f2"], min_train=200,
                                   min_cal=200, boosting=Boosting(rounds=20)))
    return data, folds, out


def test_folds_and_fits_equal_direct_fits(fits):
    data, folds, out = fits
    rows = out.toPandas()
    assert len(rows) == 2 * 4 * 4
    marks = folds.toPandas().set_index("fold_id")
    data = data.dropna()
    for _, f in rows[rows["fold_id"] == 3].iterrows():
        m, own = marks.loc[3], data[data["s"] == f["s"]]
        train = own[(own["ts"] >= m["train_start"]) & (own["ts"] < m["cal_start"])]
        test = own[(own["ts"] >= m["test_start"]) & (own["ts"] < m["test_end"])]
        assert (f["n_train"], len(f["test"])) == (len(train), len(test))
        fitted, predict, _ = fit_model(f["model"], train[["f0", "f1", "f2"]].to_numpy(), train["y"].to_numpy(), 4, Boosting(rounds=20))
        assert f["train_mae"] == pytest.approx(np.abs(fitted - train["y"]).mean())
        np.testing.assert_allclose([p["yhat"] for p in f["test"]], predict(test[["f0", "f1", "f2"]].to_numpy()))


def test_short_folds_are_skipped(spark, fits):
    data, folds, _ = fits
    none = walk_forward(spark.createDataFrame(data), folds, series=["s"], ts="ts", y="y", features=["f0", "f1", "f2"], models=["ridge"])
    assert none.count() == 0  # 4,000 training rows are asked for


def test_metrics_and_conformal_pass_equal_sql(spark, fits):
    _, _, out = fits
    test, cal = predictions_of(out, ["s"]).toPandas(), predictions_of(out, ["s"], "cal").toPandas()  # noqa: F841
    head = out.select("s", "fold_id", "model", "train_mae").toPandas()  # noqa: F841
    sql = """
WITH r AS (SELECT s, fold_id, model, hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia') AS hour, abs(y - yhat) AS a FROM cal),
kc AS (SELECT *, row_number() OVER (PARTITION BY s, fold_id, model, hour ORDER BY a) AS rn, count(*) OVER (PARTITION BY s, fold_id, model, hour) AS m FROM r),
w AS (SELECT s, fold_id, model, hour, a AS w FROM kc WHERE rn = least(ceil((m + 1) * 0.9), m))
SELECT t.s, t.fold_id, t.model, t.ts, yhat - w AS lo, yhat + w AS hi, CAST(y BETWEEN yhat - w AND yhat + w AS INT) AS inside
FROM test t JOIN w ON w.s = t.s AND w.fold_id = t.fold_id AND w.model = t.model
  AND w.hour = hour((t.ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia') ORDER BY ALL"""
    duckdb.execute("SET TimeZone = 'UTC'")
    want = duckdb.sql(sql).df()
    got = conformal_pass(out, ["s"]).select("s", "fold_id", "model", "ts", "lo", "hi", F.col("in").alias("inside")).toPandas()
    got = got.sort_values(["s", "fold_id", "model", "ts"]).reset_index(drop=True)
    assert len(want) == len(got) == len(test)
    np.testing.assert_allclose(got[["lo", "hi", "inside"]].to_numpy(float), want[["lo", "hi", "inside"]].to_numpy(float))
    assert 0.8 < got["inside"].mean() < 0.99
    m = duckdb.sql("SELECT s, model, avg(abs(yhat - y)) AS e FROM test GROUP BY ALL ORDER BY ALL").df()
    found = fold_metrics(out, ["s"]).orderBy("s", "model").toPandas()
    np.testing.assert_allclose(found["test_mae"], m["e"])
    np.testing.assert_allclose(found["train_mae"], head.groupby(["s", "model"])["train_mae"].mean().to_numpy())
