"""Every model of every fold, refitted on bounded windows in parallel.

A fold's window is bounded by the calendar: training span over step (the reference's 589
days of hours are 14,136 rows), whatever the number of series or the length of a series.
So one task takes a few consecutive folds of one series, with the rows from the first
training start to the last test end, and fits all models there. A row travels to as many
tasks as batches of folds reach it, not to each fold; nothing else is shuffled, no
row comes back but test and calibration predictions. ``linear.py`` keeps the Gram tables
for windows that are not bounded like this.

* ridge: alpha by exact leave-one-out errors (the eigenbasis of the window gives every
  row's leverage for all alphas at once);
* lasso and elastic net: cross-validation over consecutive splits, exact paths;
* boosted trees: :mod:`boosting`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosting import Boosting, fit_boosted
from .evaluate import mondrian_widths
from .folds import rows_in_folds
from .linear import EN_L1_RATIOS, RIDGE_ALPHAS, Gram, _alpha_grid, elastic_net_path, lasso_path_lars

MODELS = ("ridge", "lasso", "elasticnet", "xgboost")
#: A task's window may hold this many numbers (rows times columns); beyond it, take fewer folds a task or Gram tables.
MOST_NUMBERS = 50_000_000


def ridge_loo(x: np.ndarray, y: np.ndarray, alphas: Sequence[float] = RIDGE_ALPHAS) -> tuple[np.ndarray, float, float, np.ndarray]:
    """``(beta, intercept, alpha, errors)``: ridge with the alpha of the smallest mean squared leave-one-out error.

    The intercept is not penalised: with centred columns ``z`` and the eigenbasis of ``zᵀz``, row i's
    leverage is ``1/n + Σ_j (z_i·v_j)² / (λ_j + α)`` and its left-out error ``r_i / (1 − h_i)``.
    """
    mx, my = x.mean(0), y.mean()
    z, c = x - mx, y - my
    values, basis = np.linalg.eigh(z.T @ z)
    values = np.clip(values, 0, None)
    proj = z @ basis
    target = proj.T @ c
    shrink = 1 / (values[:, None] + np.asarray(alphas)[None, :])
    residual = c[:, None] - proj @ (target[:, None] * shrink)
    left_out = residual / (1 - 1 / len(y) - (proj * proj) @ shrink)
    errors = np.mean(left_out ** 2, axis=0)
    best = int(np.argmin(errors))
    beta = basis @ (target * shrink[:, best])
    return beta, float(my - mx @ beta), float(alphas[best]), errors


def gram_of(x: np.ndarray, y: np.ndarray) -> Gram:
    return Gram(len(y), y.sum(), y @ y, x.sum(0), x.T @ y, x.T @ x)


def cross_validated(x: np.ndarray, y: np.ndarray, l1_ratios: Sequence[float], cv_splits: int):
    """LassoCV / ElasticNetCV on standardised columns: ``(beta, intercept, alpha, l1_ratio)``.

    The rows are cut into ``cv_splits`` + 1 consecutive stretches (the first takes the rest); each one after
    the first is predicted from all before it. Alphas: a grid from the whole window's largest.
    """
    n, size = len(y), len(y) // (cv_splits + 1)
    cuts = [n - size * (cv_splits - i) for i in range(cv_splits)] + [n]
    whole, one = gram_of(x, y), np.ones(x.shape[1])
    zero = np.zeros(x.shape[1])
    cxx, cxy, _, _, _ = whole.centred(zero, one)
    splits = [(gram_of(x[:a], y[:a]), gram_of(x[a:b], y[a:b])) for a, b in zip(cuts, cuts[1:])]
    best = None
    for rho in l1_ratios:
        alphas = _alpha_grid(cxy, n, rho)
        mse = np.zeros(len(alphas))
        for train, test in splits:
            sxx, sxy, _, xbar, ybar = train.centred(zero, one)
            path = lasso_path_lars(sxx, sxy, train.n, alphas) if rho == 1 else elastic_net_path(sxx, sxy, train.n, alphas, rho)
            mse += [test.sse(ybar - float(xbar @ b), b, zero, one) / max(test.n, 1) for b in path]
        i = int(np.argmin(mse))
        if best is None or mse[i] < best[0]:
            best = (mse[i], alphas[i], rho)
    _, alpha, rho = best
    beta = lasso_path_lars(cxx, cxy, n, [alpha])[0] if rho == 1 else elastic_net_path(
        cxx, cxy, n, [a for a in _alpha_grid(cxy, n, rho) if a >= alpha], rho)[-1]
    return beta, float(whole.sy / n - whole.sx @ beta / n), float(alpha), float(rho)


_POINT = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("y", T.DoubleType()),
                       T.StructField("yhat", T.DoubleType())])
FIT_SCHEMA = [
    T.StructField("fold_id", T.IntegerType()), T.StructField("model", T.StringType()), T.StructField("n_train", T.LongType()),
    T.StructField("n_cal", T.LongType()), T.StructField("train_mae", T.DoubleType()), T.StructField("alpha", T.DoubleType()),
    T.StructField("l1_ratio", T.DoubleType()), T.StructField("intercept", T.DoubleType()),
    T.StructField("beta", T.ArrayType(T.DoubleType())), T.StructField("importance", T.ArrayType(T.DoubleType())),
    T.StructField("cal", T.ArrayType(_POINT)), T.StructField("test", T.ArrayType(_POINT))]


def fit_model(model: str, x: np.ndarray, y: np.ndarray, cv_splits: int, boosting: Boosting):
    """``(fitted values, predict, row of the fit table)`` of one model on one window."""
    if model == "xgboost":
        trees, fitted = fit_boosted(x, y, boosting)
        return fitted, trees.predict, {"importance": trees.importance().tolist()}
    mu, sd = x.mean(0), x.std(0)
    sd[sd <= 1e-12 * np.maximum(1.0, np.abs(mu))] = 1.0
    z = (x - mu) / sd
    if model == "ridge":
        beta, b0, alpha, _ = ridge_loo(z, y)
        rho = 0.0
    else:
        beta, b0, alpha, rho = cross_validated(z, y, (1.0,) if model == "lasso" else EN_L1_RATIOS, cv_splits)
    w = beta / sd
    c = b0 - float(w @ mu)
    return c + x @ w, lambda other: c + other @ w, {"alpha": alpha, "l1_ratio": rho, "intercept": c, "beta": w.tolist()}


def walk_forward(feat: DataFrame, folds: DataFrame, *, series: Sequence[str], ts: str, y: str, features: Sequence[str],
                 models: Sequence[str] = MODELS, min_train: int = 4000, min_cal: int = 0, cv_splits: int = 4,
                 folds_per_task: int = 2, boosting: Boosting = Boosting()) -> DataFrame:
    """One row per (series, fold, model): the fit, its mean absolute training error and its predictions
    on the calibration and the test rows (arrays of ``(ts, y, yhat)``, bounded by the blocks' length).

    ``folds`` as in :func:`folds.fold_table`. Rows with a NULL are left out. A fold with fewer than ``min_train``
    training rows or ``min_cal`` calibration rows, or without test rows, is skipped. Timestamps must be unique
    within a series.
    """
    series, features, models = list(series), list(features), list(models)
    k = len(features)
    batch = F.floor((F.col("fold_id") - 1) / F.lit(folds_per_task)).cast("int")
    spans = folds.groupBy(batch.alias("fold_id")).agg(F.min("train_start").alias("a"), F.max("test_end").alias("b"))
    marks = ["train_start", "cal_start", "test_start", "test_end"]
    plan = folds.groupBy(batch.alias("_batch")).agg(F.array_sort(F.collect_list(F.struct(
        "fold_id", *[F.unix_micros(m).alias(m) for m in marks]))).alias("_folds"))
    comp = feat.select(*series, ts, F.col(y).cast("double").alias("_y"), *[F.col(f).cast("double") for f in features]).dropna()
    rows = rows_in_folds(comp, spans, ts, "a", "b").withColumnRenamed("fold_id", "_batch").withColumn("_t", F.unix_micros(ts))
    # a fit is long and its rows are few: with an explicit number, small partitions are not merged into one task
    spark = feat.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    counted = rows.repartition(tasks, *series, "_batch").groupBy(*series, "_batch")
    table = plan.select("_batch", "_folds")

    def fit(key, window: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        out_cols = [*series, *[f.name for f in FIT_SCHEMA]]
        out = []
        if len(window) and len(own):
            if len(window) * (k + 2) > MOST_NUMBERS:
                raise ValueError(f"a window of {len(window)} rows is too long for a task; take fewer folds_per_task or Gram tables")
            window = window.sort_values("_t", kind="stable")
            t, stamps = window["_t"].to_numpy(), window[ts].to_numpy()
            x, target = window[features].to_numpy(float), window["_y"].to_numpy(float)
            for f in own["_folds"].iloc[0]:
                a, b, c, d = (int(np.searchsorted(t, f[m])) for m in marks)
                if b - a < max(min_train, 2) or c - b < min_cal or d <= c:
                    continue
                for model in models:
                    fitted, predict, said = fit_model(model, x[a:b], target[a:b], cv_splits, boosting)

                    def points(lo, hi, predict=predict):
                        return [] if hi <= lo else [{"ts": s, "y": v, "yhat": p} for s, v, p in
                                                    zip(pd.DatetimeIndex(stamps[lo:hi]), target[lo:hi], predict(x[lo:hi]))]

                    out.append({**dict(zip(series, key)), "fold_id": int(f["fold_id"]), "model": model, "n_train": b - a,
                                "n_cal": c - b, "train_mae": float(np.mean(np.abs(fitted - target[a:b]))),
                                "cal": points(b, c), "test": points(c, d), **said})
        frame = pd.DataFrame(out, columns=out_cols)
        return frame.astype(object).where(frame.notna(), None) if len(frame) else frame

    schema = T.StructType([feat.schema[c] for c in series] + FIT_SCHEMA)
    # each (series, batch) is told its folds: one row per batch, a table bounded by the calendar
    own = [f"_own{i}" for i in range(len(series) + 1)]
    told = (rows.select(*[F.col(c).alias(o) for c, o in zip([*series, "_batch"], own)]).distinct()
            .join(F.broadcast(table), F.col(own[-1]) == F.col("_batch")).select(*own, "_folds"))
    return counted.cogroup(told.groupBy(*own)).applyInPandas(fit, schema)


def predictions_of(fits: DataFrame, series: Sequence[str], part: str = "test") -> DataFrame:
    """``(series…, fold_id, model, ts, y, yhat)`` from the ``test`` (or ``cal``) arrays of a fit table."""
    return fits.select(*series, "fold_id", "model", F.inline(part))


def fold_metrics(fits: DataFrame, series: Sequence[str]) -> DataFrame:
    """``n, test_mae, train_mae, overfit`` per (series, model): the training error is the mean over folds."""
    g = [*series, "model"]
    test = predictions_of(fits, series).groupBy(*g).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("yhat") - F.col("y"))).alias("test_mae"))
    train = fits.groupBy(*g).agg(F.avg("train_mae").alias("train_mae"), F.count(F.lit(1)).alias("folds"))
    return test.join(train, g).withColumn("overfit", F.try_divide("test_mae", "train_mae"))


def conformal_pass(fits: DataFrame, series: Sequence[str], alpha: float = 0.10, tz: str = "Europe/Sofia") -> DataFrame:
    """``(series…, fold_id, model, ts, y, p, w, lo, hi, in)``.

    Each fold's model was refitted on the rows before its calibration block; the widths are the Mondrian
    quantiles of its residuals there, per local hour, and the intervals those of its test block.
    """
    g = [*series, "fold_id", "model"]
    hour = F.hour(F.from_utc_timestamp("ts", tz))
    cal = predictions_of(fits, series, "cal").select(*g, hour.alias("hour"), (F.col("y") - F.col("yhat")).alias("r"))
    widths = mondrian_widths(cal, g, "hour", "r", alpha)
    test = predictions_of(fits, series).withColumn("hour", hour).withColumnRenamed("yhat", "p")
    lo, hi = F.col("p") - F.col("w"), F.col("p") + F.col("w")
    return test.join(widths, [*g, "hour"]).select(
        *g, "ts", "y", "p", "w", lo.alias("lo"), hi.alias("hi"), F.col("y").between(lo, hi).cast("int").alias("in"))
