"""Group D: row-wise and grouped aggregates, forecast metrics, interval quality.

All are single ``groupBy().agg()`` passes (partial aggregation before the
shuffle), so a group holding a third of all rows is combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import vector_direction


def row_sum_zero(cols: Sequence[str], plus: str | None = None) -> Column:
    """Σ coalesce(c, 0) (+ ``plus`` as is, so NULL ``plus`` gives NULL)."""
    s = F.lit(0.0)
    for c in cols:
        s = s + F.coalesce(F.col(c), F.lit(0.0))
    return s + F.col(plus) if plus else s


def cross_mean(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Mean across locations per key, missing skipped."""
    return df.groupBy(*keys).agg(F.avg(value).alias(out or value))


def vector_mean_direction(df: DataFrame, keys: Sequence[str], direction: str, speed: str | None = None,
                          n_locations: int | None = None, out: str = "direction") -> DataFrame:
    """D3 (speed-weighted) / D4 (``speed=None``, circular mean) of directions in degrees.

    Strict by default like a NumPy mean: when ``n_locations`` is given, a key with
    fewer than that many complete (direction, speed) pairs yields NULL.
    """
    th = F.radians(F.col(direction))
    s = F.col(speed) if speed else F.lit(1.0)
    ok = F.col(direction).isNotNull() & s.isNotNull()
    agg = df.groupBy(*keys).agg(F.avg(F.when(ok, s * F.sin(th))).alias("_s"),
                                F.avg(F.when(ok, s * F.cos(th))).alias("_c"),
                                F.count_if(ok).alias("_n"))
    d = vector_direction(F.col("_s"), F.col("_c"))
    if n_locations is not None:
        d = F.when(F.col("_n") >= n_locations, d)
    return agg.select(*keys, d.alias(out))


def forecast_metrics(df: DataFrame, group: Sequence[str], y: str = "y", yhat: str = "yhat",
                     k: int | str | Column = 0) -> DataFrame:
    """N, MAE, RMSE, MAPE % (÷ y), R², adjusted R² with k predictors, bias (mean of ŷ−y).

    ``k`` may be a column (per-model predictor count). One aggregation pass:
    SST = n · var_pop(y). Rows with y = 0 don't enter the MAPE; R² of a constant y is NULL.
    """
    e = F.col(yhat) - F.col(y)
    kk = F.col(k) if isinstance(k, str) else (k if isinstance(k, Column) else F.lit(k))
    agg = df.groupBy(*group, kk.alias("_k")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.try_divide(F.abs(e), F.col(y))) * 100).alias("mape"), F.sum(e * e).alias("_sse"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_sst"), F.avg(e).alias("bias"))
    r2 = 1 - F.try_divide(F.col("_sse"), F.col("_sst"))
    adj = 1 - F.try_divide((1 - r2) * (F.col("n") - 1), F.col("n") - F.col("_k") - 1)
    return agg.select(*group, "n", "mae", "rmse", "mape", r2.alias("r2"), adj.alias("adj_r2"), "bias")


def standardized_metrics(df: DataFrame, group: Sequence[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """MSE, RMSE, MAE and MAPE as a fraction (÷ |y|) — standardised-unit scores."""
    e = F.col(yhat) - F.col(y)
    return df.groupBy(*group).agg(F.avg(e * e).alias("mse"), F.sqrt(F.avg(e * e)).alias("rmse"),
                                  F.avg(F.abs(e)).alias("mae"), F.avg(F.try_divide(F.abs(e), F.abs(F.col(y)))).alias("mape"))


def skill_vs_benchmark(metrics: DataFrame, group: Sequence[str], model: str, benchmark: str,
                       value: str = "mae", out: str | None = None) -> DataFrame:
    """``(b − m) / b · 100`` against the benchmark row of the same group."""
    b = metrics.filter(F.col(model) == benchmark).select(*group, F.col(value).alias("_b"))
    j = metrics.join(b, list(group), "left")
    return j.withColumn(out or f"skill_vs_{benchmark}", (F.col("_b") - F.col(value)) / F.col("_b") * 100).drop("_b")


def overfit_ratio(test_mae: Column, train_mae: Column) -> Column:
    """Test MAE / train MAE."""
    return test_mae / train_mae


def daily_peak(df: DataFrame, group: Sequence[str], ts: str, y: str, tz: str = "Europe/Sofia") -> DataFrame:
    """The hour of each local date with the largest actual (earliest on ties)."""
    d = df.withColumn("local_date", F.to_date(F.from_utc_timestamp(F.col(ts), tz)))
    w = Window.partitionBy(*group, "local_date").orderBy(F.col(y).desc(), F.col(ts))
    return d.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def peak_metrics(df: DataFrame, group: Sequence[str], ts: str, y: str, yhat: str, tz: str = "Europe/Sofia") -> DataFrame:
    """MAE and MAPE % at each local day's peak hour."""
    p = daily_peak(df, group, ts, y, tz)
    e = F.abs(F.col(yhat) - F.col(y))
    return p.groupBy(*group).agg(F.count(F.lit(1)).alias("days"), F.avg(e).alias("peak_mae"),
                                 (F.avg(F.try_divide(e, F.col(y))) * 100).alias("peak_mape"))


def pearson(a: str, b: str) -> Column:
    """Pearson correlation over rows with both values; NULL where either is constant."""
    x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
    return F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(x)) * F.sqrt(F.var_pop(y)))


def correlations(df: DataFrame, target: str, features: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """corr(feature, target) for every feature in one pass, long form, per ``group``."""
    row = df.groupBy(*group).agg(*[pearson(f, target).alias(f) for f in features])
    return row.unpivot(list(group), list(features), "feature", "corr")


def correlation_matrix(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature × feature Pearson matrix (long: a, b, corr) from one aggregation."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i:]]
    row = df.agg(*[pearson(a, b).alias(f"{a}\u0001{b}") for a, b in pairs])
    long = row.unpivot([], [f"`{a}\u0001{b}`" for a, b in pairs], "_p", "corr")
    parts = F.split(F.col("_p"), "\u0001")
    upper = long.select(parts[0].alias("a"), parts[1].alias("b"), "corr")
    lower = upper.filter(F.col("a") != F.col("b")).select(F.col("b").alias("a"), F.col("a").alias("b"), "corr")
    return upper.unionByName(lower)


def standardize_stats(df: DataFrame, cols: Sequence[str], ddof: int = 0, keep_dummies: bool = False) -> DataFrame:
    """Per-column mean and std (ddof 0 or 1) — one row; dummy flag when 0/1 only."""
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), sd(c).alias(f"{c}__std")]
        if keep_dummies:
            aggs.append((F.count_if(~F.col(c).isin(0, 1)) == 0).alias(f"{c}__dummy"))
    return df.agg(*aggs)


def standardize(df: DataFrame, cols: Sequence[str], stats: DataFrame | None = None, ddof: int = 0,
                keep_dummies: bool = False) -> DataFrame:
    """``(x − mean) / std``; constant columns → 0; with ``keep_dummies`` 0/1 columns untouched.

    ``stats`` (one row, from :func:`standardize_stats` on the *training* rows) is
    cross-joined as a broadcast — it is a single row, so the size is fixed.
    """
    st = stats if stats is not None else standardize_stats(df, cols, ddof, keep_dummies)
    j = df.crossJoin(F.broadcast(st))
    out = []
    for c in df.columns:
        if c in cols:
            z = F.when(F.col(f"{c}__std") > 0, (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std")).otherwise(
                F.when(F.col(c).isNotNull(), F.lit(0.0)))
            if keep_dummies:
                z = F.when(F.col(f"{c}__dummy"), F.col(c).cast("double")).otherwise(z)
            out.append(z.alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def interval_quality(df: DataFrame, group: Sequence[str], y: str = "y", lo: str = "lo", hi: str = "hi",
                     alpha: float = 0.10) -> DataFrame:
    """Coverage %, mean half-width, Winkler score."""
    below = F.when(F.col(y) < F.col(lo), (2 / alpha) * (F.col(lo) - F.col(y))).otherwise(0.0)
    above = F.when(F.col(y) > F.col(hi), (2 / alpha) * (F.col(y) - F.col(hi))).otherwise(0.0)
    inside = ((F.col(y) >= F.col(lo)) & (F.col(y) <= F.col(hi))).cast("double")
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), (F.avg(inside) * 100).alias("coverage_pct"),
                                  F.avg((F.col(hi) - F.col(lo)) / 2).alias("mean_half_width"),
                                  F.avg(F.col(hi) - F.col(lo) + below + above).alias("winkler"))


def distribution_summary(df: DataFrame, group: Sequence[str], x: str) -> DataFrame:
    """N, mean, std (ddof 0), skewness and kurtosis (Pearson, normal = 3)."""
    return df.groupBy(*group).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"),
                                  F.skewness(x).alias("skew"), (F.kurtosis(x) + 3).alias("kurtosis"))


def density_histogram(df: DataFrame, group: Sequence[str], x: str, bins: int = 60) -> DataFrame:
    """Equal-width histogram as a density (count / (n · width)), like ``hist(density=True)``.

    Bounds come from one aggregation per group; the last bin is closed.
    """
    b = df.groupBy(*group).agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"), F.count(x).alias("_n"))
    j = df.filter(F.col(x).isNotNull()).join(b, list(group)) if group else df.filter(F.col(x).isNotNull()).crossJoin(b)
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.least(F.floor((F.col(x) - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    idx = F.when(width > 0, idx).otherwise(F.lit(0))
    h = j.groupBy(*group, idx.alias("bin"), "_lo", "_hi", "_n").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return h.select(*group, "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_left"), "count",
                    F.when(w > 0, F.col("count") / (F.col("_n") * w)).alias("density"))


def line_fit(df: DataFrame, group: Sequence[str], y: str, x: str) -> DataFrame:
    """Least-squares line of y on x (actual vs predicted)."""
    return df.groupBy(*group).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def event_loss(nominal: str, available: str) -> Column:
    """``max(nominal − coalesce(available, 0), 0)``."""
    return F.greatest(F.col(nominal) - F.coalesce(F.col(available), F.lit(0.0)), F.lit(0.0))
