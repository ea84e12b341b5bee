"""Elastic net's duality gap, linear fits at fixed penalties, supply models, pruning and fold plans."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridcast.operators.aggregates import correlations
from gridcast.plans.diagnostics import prune_features
from gridcast.plans.linear import _cd_batch, duality_gap, fixed_linear, fold_plan
from gridcast.plans.trees import supply_models


def data(n=240, seed=11):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    return x, x @ [1.5, -0.7, 0.0] + 0.3 * rng.normal(size=n)


def test_duality_gap_bounds_the_objective():
    x, y = data()
    x, y = x - x.mean(0), y - y.mean()
    args = [x.T @ x], [x.T @ y], [240.0]
    best = _cd_batch(*args, [[0.05]], [0.7], tol=1e-13, max_iter=20000)[0, 0]

    def objective(b):
        return 0.5 * ((y - x @ b) ** 2).sum() + 240 * 0.05 * (0.7 * np.abs(b).sum() + 0.15 * (b ** 2).sum())

    def gap(b):
        return float(duality_gap(*map(np.array, (args[0], args[1], [y @ y], args[2], [0.05], [0.7])), b[None])[0])

    assert gap(best) == pytest.approx(0, abs=1e-9)
    for b in (np.zeros(3), best * 1.1):
        assert gap(b) * (y @ y) >= objective(b) - objective(best) - 1e-9


def test_fixed_linear_ridge_is_the_closed_form(spark):
    x, y = data()
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y}))
    got = {r["model"]: r for r in fixed_linear(df, ["a", "b", "c"], "y", [("r", 2.0, 0.0), ("l", 1e6, 1.0)]).collect()}
    xc, yc = x - x.mean(0), y - y.mean()
    beta = np.linalg.solve(xc.T @ xc + 2 * np.eye(3), xc.T @ yc)
    assert np.allclose(got["r"]["beta"], beta)
    assert got["r"]["intercept"] == pytest.approx(y.mean() - x.mean(0) @ beta)
    assert got["l"]["beta"] == [0.0] * 3 and got["l"]["intercept"] == pytest.approx(y.mean())


def test_supply_models_give_all_models_and_metrics(spark):
    x, y = data()
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(len(y)), "a": x[:, 0], "b": x[:, 1], "s": y}))
    df = df.select(F.timestamp_seconds(F.col("i") * 3600).alias("ts"), "a", "b", "s")
    got = {r["model"]: r for r in supply_models(df, "ts", "s", ["a", "b"], "1970-01-08 00:00:00",
                                                {"DecisionTree": {"maxDepth": 3}}).collect()}
    assert set(got) == {"Lasso", "Ridge", "ElasticNet", "DecisionTree", "naive"}
    cut = 7 * 24
    std = lambda v: (v - v.mean()) / v.std(ddof=1)
    expected = np.mean((std(y[cut:]) - std(y[:cut])[-1]) ** 2)
    assert got["naive"]["mse"] == pytest.approx(expected) and got["naive"]["n"] == len(y) - cut
    assert got["Ridge"]["rmse"] == pytest.approx(got["Ridge"]["mse"] ** 0.5)
    assert got["Ridge"]["mse"] < 0.2


def test_pruning_keeps_what_has_no_statistic(spark):
    rows = pd.DataFrame({"g": ["u"] * 40, "y": np.arange(40.0), "same": 1.0, "noise": [1.0, -1.0] * 20,
                         "good": np.arange(40.0) + 0.5})
    corr = correlations(spark.createDataFrame(rows), "y", ["same", "noise", "good"], ["g"])
    p = spark.createDataFrame([("u", "same", float("nan")), ("u", "noise", 0.7), ("u", "good", 0.9)],
                              "g string, feature string, p double")
    keep = {r["feature"]: r["keep"] for r in prune_features(p, corr, on=["g", "feature"]).collect()}
    assert keep == {"same": True, "noise": False, "good": True}


def test_fold_plan_positions_match_plain_counts(spark):
    days = np.delete(np.arange(100), [3, 40, 41])
    comp = spark.createDataFrame(pd.DataFrame({"g": "u", "d": days})).select("g", F.timestamp_seconds(F.col("d") * 86400).alias("ts"))
    at = lambda d: F.timestamp_seconds(F.lit(d * 86400))
    folds = spark.range(1, 3).select(F.col("id").cast("int").alias("fold_id"), at(2).alias("train_start"),
                                     F.when(F.col("id") == 1, at(50)).otherwise(at(60)).alias("cal_start"),
                                     F.when(F.col("id") == 1, at(55)).otherwise(at(60)).alias("test_start"),
                                     F.when(F.col("id") == 1, at(60)).otherwise(at(70)).alias("test_end"))
    got = {(r["fold_id"], r["role"]): (r["lo"], r["hi"]) for r in fold_plan(comp, folds, ["g"], "ts", 10, 2).collect()}
    before = lambda d: int((days < d).sum())
    assert got[1, "train"] == (before(2), before(50)) and got[1, "cal"] == (before(50), before(55))
    assert got[1, "test"] == (before(55), before(60)) and (2, "cal") not in got
    size = (before(60) - before(2)) // 3
    assert got[2, "cvtest1"] == (before(60) - size, before(60))
    assert got[2, "cvtrain1"] == (before(2), before(60) - size)
