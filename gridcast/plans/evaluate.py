"""Evaluation plans: prediction tables, conformal widths, scores, selection, ramps.

Predictions are long: ``(series…, model, ts, y, yhat)``. Every step is a
grouped aggregation or a window over a bounded group, never over a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.windows import Lookback, lookback_features, time_position
from ..session import cut_lineage


def naive_predictions(grid: DataFrame, series: Sequence[str] = ("series_id",), ts: str = "ts", y: str = "value",
                      step_seconds: int = 3600, complete: bool = True) -> DataFrame:
    """Persistence / seasonal-naive forecasts from lags (24, 168) and the lagged
    rolling mean (``mean24`` = mean over positions [t−47, t−24], ≥ 12 values).

    ``complete`` keeps only rows where every model has a value (the reference
    aligns models with a ``dropna`` before scoring).
    """
    g = grid.withColumn("_p", time_position(ts, step_seconds))
    spec = (Lookback().lag("naive24", y, 24).lag("naive168", y, 168)
            .rolling_mean("mean24", y, 47, 24, 12))
    f = lookback_features(g, list(series), "_p", spec).drop("_p")
    models = ["naive24", "naive168", "mean24"]
    if complete:
        f = f.dropna(subset=[y, *models])
    long = f.select(*series, ts, F.col(y).alias("y"), *models).unpivot([*series, ts, "y"], models, "model", "yhat")
    return long if complete else long.filter(F.col("yhat").isNotNull() & F.col("y").isNotNull())


def residual_counts(residuals: DataFrame, group: Sequence[str], r: str = "r") -> DataFrame:
    """``(group…, _a, _n)``: how often each |r| occurs, written once; every rank below is read from it."""
    a = residuals.select(*group, F.abs(F.col(r)).alias("_a")).filter(F.col("_a").isNotNull())
    return cut_lineage(a.groupBy(*group, "_a").agg(F.count(F.lit(1)).alias("_n")))


def quantile_of_counts(values: DataFrame, group: Sequence[str], alpha: float, out: str, slices: int = 256) -> DataFrame:
    """E5 from ``(group…, _a, _n)`` with distinct ``_a`` in a group: ``(group…, m, out)``."""
    g = list(group)
    marks = F.percentile_approx("_a", [i / slices for i in range(1, slices)], 10 * slices)
    rank = F.least(F.ceil((F.col("m") + 1) * (1 - alpha)), F.col("m"))
    cuts = values.groupBy(*g).agg(marks.alias("_cuts"), F.sum("_n").alias("m")).withColumn("_k", rank)
    values = (values.join(cuts, g)
              .withColumn("_slice", F.size(F.filter("_cuts", lambda c: c < F.col("_a")))).drop("_cuts"))
    sizes = values.groupBy(*g, "_slice", "m", "_k").agg(F.sum("_n").alias("_size"))  # at most ``slices`` rows a group
    upto = F.sum("_size").over(Window.partitionBy(*g).orderBy("_slice"))
    held = (sizes.withColumn("_upto", upto).filter((F.col("_k") <= F.col("_upto")) & (F.col("_k") > F.col("_upto") - F.col("_size")))
            .select(*g, "_slice", (F.col("_k") - F.col("_upto") + F.col("_size")).alias("_left")))
    seen = F.sum("_n").over(Window.partitionBy(*g).orderBy("_a"))
    return (values.join(held, [*g, "_slice"]).withColumn("_seen", seen).filter("_seen >= _left")
            .groupBy(*g, "m").agg(F.min("_a").alias(out)))


def conformal_quantile(residuals: DataFrame, group: Sequence[str], r: str = "r", alpha: float = 0.10,
                       out: str = "q", slices: int = 256) -> DataFrame:
    """E5: per group the k-th smallest |r| with ``k = min(ceil((m+1)(1−α)), m)``.

    Discrete order statistic (no interpolation), exact. The distinct values of a group are cut
    into about equal ``slices`` at approximate percentiles; counts per slice tell which one
    holds rank k, and only that slice's values are put in order.
    """
    return quantile_of_counts(residual_counts(residuals, group, r), group, alpha, out, slices)


def mondrian_widths(residuals: DataFrame, group: Sequence[str], cell: str = "hour", r: str = "r",
                    alpha: float = 0.10, cells: Sequence[int] = tuple(range(24))) -> DataFrame:
    """Width per (group, cell) = E5 within the cell, falling back to the group's
    global quantile when the cell has no residuals. The residuals are read once."""
    counts = residual_counts(residuals, [*group, cell], r)
    per = quantile_of_counts(counts, [*group, cell], alpha, "q_cell").drop("m")
    whole = counts.groupBy(*group, "_a").agg(F.sum("_n").alias("_n"))
    glob = quantile_of_counts(whole, group, alpha, "q_all").drop("m")
    # one row per group × 24 cells: bounded by the number of groups
    full = glob.withColumn(cell, F.explode(F.array(*[F.lit(int(c)) for c in cells])))
    j = full.join(per, [*group, cell], "left")
    return j.select(*group, cell, F.coalesce("q_cell", "q_all").alias("w"))


def minmax_lower_better(x: str, over: Sequence[str] = ()) -> Column:
    """``(max − x) / (max − min)`` within ``over``; constant → 1.0."""
    w = Window.partitionBy(*over)
    mx, mn = F.max(x).over(w), F.min(x).over(w)
    return F.when(mx - mn > 0, (mx - F.col(x)) / (mx - mn)).otherwise(F.lit(1.0))


def composite_selection(scores: DataFrame, group: Sequence[str], model: str, metrics: Sequence[str],
                        model_order: Sequence[str] | None = None) -> DataFrame:
    """Mean of E7 scores over ``metrics``; the best model per group
    (first in ``model_order`` on ties)."""
    s = scores
    for m in metrics:
        s = s.withColumn(f"s_{m}", minmax_lower_better(m, group))
    s = s.withColumn("score", sum(F.col(f"s_{m}") for m in metrics) / len(metrics))
    if model_order:
        ordinal = F.array_position(F.array(*[F.lit(x) for x in model_order]), F.col(model))
    else:
        ordinal = F.col(model)
    w = Window.partitionBy(*group).orderBy(F.col("score").desc(), ordinal)
    return s.withColumn("rank", F.row_number().over(w)).withColumn("selected", F.col("rank") == 1)


def naive_last_value(train: DataFrame, test: DataFrame, series: Sequence[str], ts: str, y: str) -> DataFrame:
    """Forecast every test row with the last training value of its series."""
    last = train.filter(F.col(y).isNotNull()).groupBy(*series).agg(F.max_by(y, ts).alias("yhat"))
    return test.join(last, list(series), "left")


def linear_ramp(df: DataFrame, series: Sequence[str], ts: str, anchor: str, forecast: str,
                steps: int = 4, step_minutes: int = 15, out: str = "p15") -> DataFrame:
    """From the current value ``a`` to the hourly forecast ``f``: ``a + (q/steps)(f − a)``
    stamped at ``ts − (steps − q)·step`` for q = 1..steps; rows missing either end are
    skipped; on duplicate stamps the last written (latest source row) wins."""
    d = df.filter(F.col(anchor).isNotNull() & F.col(forecast).isNotNull())
    e = d.select(*series, F.col(ts).alias("_src"), anchor, forecast,
                 F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("q"))
    stamp = F.col("_src") - F.make_dt_interval(F.lit(0), F.lit(0), (F.lit(steps) - F.col("q")) * step_minutes)
    val = F.col(anchor) + (F.col("q") / F.lit(steps)) * (F.col(forecast) - F.col(anchor))
    r = e.select(*series, stamp.alias("ts"), F.col("_src"), val.alias(out))
    w = Window.partitionBy(*series, "ts").orderBy(F.col("_src").desc())
    return r.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_src")


def winkler(y: Column, lo: Column, hi: Column, alpha: float = 0.10) -> Column:
    """Winkler interval score of one row."""
    return (hi - lo) + F.when(y < lo, (2 / alpha) * (lo - y)).otherwise(0.0) + F.when(
        y > hi, (2 / alpha) * (y - hi)).otherwise(0.0)
