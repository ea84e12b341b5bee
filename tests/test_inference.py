"""HAC regression, ARCH-LM, Diebold-Mariano and bias tests against plain numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.plans.diagnostics import arch_lm, autocovariances, diebold_mariano, hac_mean_test, ols_hac


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns)).withColumn("ts", F.timestamp_seconds(F.col("i") * 3600))


def bartlett(s, lags):
    """Long-run sum of outer products of the rows of ``s``."""
    total = s.T @ s
    for k in range(1, lags + 1):
        part = s[k:].T @ s[:-k]
        total += (1 - k / (lags + 1)) * (part + part.T)
    return total


@pytest.mark.parametrize("lags", [0, 5, 48])
def test_ols_hac_equals_plain_bartlett(spark, lags):
    rng = np.random.default_rng(5)
    n = 400
    x = rng.normal(size=(n, 3)).cumsum(axis=0) * 0.1 + 50
    y = 1e4 + x @ [2.0, -1.0, 0.0] + rng.normal(size=n)
    df = frame(spark, g=["a"] * n, i=np.arange(n), y=y, a=x[:, 0], b=x[:, 1], c=x[:, 2])
    got = {r["feature"]: r for r in ols_hac(df, ["g"], "ts", "y", ["a", "b", "c"], lags).collect()}
    z = np.column_stack([np.ones(n), (x - x.mean(0)) / x.std(0, ddof=1)])
    inv = np.linalg.inv(z.T @ z)
    beta = inv @ z.T @ y
    se = np.sqrt(np.diag(inv @ bartlett(z * (y - z @ beta)[:, None], lags) @ inv))
    for i, f in enumerate(["const", "a", "b", "c"]):
        assert got[f]["coef"] == pytest.approx(beta[i], rel=1e-8)
        assert got[f]["se"] == pytest.approx(se[i], rel=1e-8)


def test_bias_and_diebold_mariano_use_the_bartlett_variance(spark):
    rng = np.random.default_rng(6)
    n = 300
    e1, e2 = rng.normal(0.1, 1, n), rng.normal(0, 1.2, n)
    df = frame(spark, g=["a"] * n, i=np.arange(n), e1=e1, e2=e2)

    def plain(d, lags):
        c = (d - d.mean())[:, None]
        return d.mean() / np.sqrt(bartlett(c, lags)[0, 0] / n / n)

    bias = hac_mean_test(autocovariances(df, ["g"], "ts", "e1", 12), ["g"], 12).first()
    assert bias["z"] == pytest.approx(plain(e1, 12), rel=1e-9)
    dm = diebold_mariano(df, ["g"], "ts", "e1", "e2", 12).first()
    assert dm["dm_stat"] == pytest.approx(plain(np.abs(e1) - np.abs(e2), 12), rel=1e-9)


def test_arch_lm_equals_plain_regression(spark):
    rng = np.random.default_rng(7)
    n, q = 500, 6
    e = rng.normal(size=n) * (1 + 0.5 * np.abs(np.sin(np.arange(n) / 9))) + 100  # far from zero
    got = arch_lm(frame(spark, g=["a"] * n, i=np.arange(n), e=e), ["g"], "ts", "e", q).first()
    v = e * e
    x = np.column_stack([np.ones(n - q), *(v[q - k:n - k] for k in range(1, q + 1))])
    r = v[q:] - x @ np.linalg.lstsq(x, v[q:], rcond=None)[0]
    assert got["arch_lm"] == pytest.approx((n - q) * (1 - r @ r / ((v[q:] - v[q:].mean()) ** 2).sum()), rel=1e-6)
