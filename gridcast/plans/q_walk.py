"""Walk-forward queries (I3-I6, I8, I13, I21-I24) on the feature tables of the three horizons.

The load is the value of all orders per hour (an order's hour is its key modulo 24), seven
years on an hourly grid, so that the reference's windows and limits hold as they are. Weather
columns are hourly aggregates of the orders, carried forward where an hour has none; the
operator's forecast is the scaled sum of three of five priorities. Fit tables are written once
per session and scale factor and read by every query that needs them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import days_off_from_dates
from ..operators.aggregates import correlations, forecast_metrics, interval_quality
from ..operators.timegrid import align_to_grid, fill_on_grid, hourly_grid
from ..operators.windows import prefix_sums, time_position
from ..session import cut_lineage
from .diagnostics import (adf_test, arch_lm, autocovariances, diebold_mariano, hac_mean_test, jarque_bera, kpss_test,
                          ljung_box, ols_hac)
from .evaluate import composite_selection
from .features import HORIZONS, WEATHER, build_features, difference_gate, feature_columns, undifference
from .folds import fold_table
from .linear import learning_curve_windows
from .registry import Tables, query
from .trees import significant_features
from .walkforward import MODELS, conformal_pass, fold_metrics, predictions_of, walk_forward

HOUR, DAY = 3600, 86400
SERIES = ["series_id"]
TARGET = "load_actual_mw"
# --- fixed values (must match the reference's windows and limits) ------------------------
TEST0, TEST_DAYS, MIN_TRAIN, CAL_DAYS, MIN_CAL = "2000-01-01 00:00:00", 15, 4000, 30, 200
TRAIN_SECONDS = {"1d": 588 * DAY + 23 * HOUR, "1w": 730 * DAY, "15min": 588 * DAY + 23 * HOUR}
PERSISTENCE = {"1d": "lag24", "1w": "lag168", "15min": "lag1"}
LEARNING_DAYS, LEARNING_MIN, VALID_DAYS = (30, 60, 90, 150, 240, 365, 480, 560, 700), 500, 45
LJUNG_BOX_LAGS, ARCH_LAGS, HAC_LAGS = {"1d": 24, "1w": 168, "15min": 24}, {"1d": 48, "1w": 48, "15min": 24}, 48
# ------------------------------------------------------------------------------------------


def shared(spark, key: tuple, build) -> DataFrame:
    """``build()`` written once per Spark context under ``key``; later queries read it from there."""
    kept = spark.sparkContext.__dict__.setdefault("_gridcast_shared", {})
    if key not in kept:
        kept[key] = cut_lineage(build())
    return kept[key]


def hourly_orders(spark, sf_dir) -> DataFrame:
    """``(series_id, ts, load, forecast, <WEATHER>)`` on the hourly grid of all orders."""
    def build():
        o = Tables(spark, sf_dir)("orders", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority")
        hour = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.pmod("o_orderkey", F.lit(24)).cast("int"))
        v = F.col("o_totalprice") / 10_000
        some = F.col("o_orderpriority") < "4"
        per = cut_lineage(o.groupBy(F.lit("orders").alias("series_id"), hour.alias("ts")).agg(
            F.sum(v).alias("load"), (F.sum(F.when(some, v).otherwise(0.0)) / 0.6).alias("forecast"), (F.avg(v) - 5).alias("temp_c"),
            F.count(F.lit(1)).cast("double").alias("wind10_ms"), F.max(v).alias("wind100_ms"), F.sum(v).alias("ghi_wm2"),
            F.min(v).alias("dni_wm2"), F.coalesce(F.stddev_samp(v), F.lit(0.0)).alias("cloud_pct"),
            (F.avg(v) - F.min(v)).alias("precip_mm"), (F.max(v) - F.min(v)).alias("rh_pct")))
        g = align_to_grid(hourly_grid(per, SERIES, "ts"), per, ["series_id", "ts"])
        return fill_on_grid(g.fillna(0.0, ["load", "forecast"]), SERIES, "ts", WEATHER)

    return shared(spark, ("hours", sf_dir), build)


def feature_table(spark, sf_dir, name: str) -> DataFrame:
    """The I27 table of a horizon on :func:`hourly_orders`, with the operator's ``forecast``."""
    def build():
        h = hourly_orders(spark, sf_dir)
        span = h.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(F.explode(F.sequence(
            F.date_sub(F.to_date("a"), 2), F.date_add(F.to_date("b"), 2))).alias("date"))
        off = cut_lineage(days_off_from_dates(spark, span))  # a calendar
        f = build_features(HORIZONS[name], h.select(*SERIES, "ts", "load"), h.select(*SERIES, "ts", *WEATHER), off)
        return f.join(h.select(*SERIES, "ts", "forecast"), ["series_id", "ts"])

    return shared(spark, ("features", sf_dir, name), build)


def folds_of(spark, sf_dir, name: str, cal_days: int = 0) -> DataFrame:
    return fold_table(spark, TEST0, hourly_orders(spark, sf_dir).agg(F.max("ts").alias("end")), test_seconds=TEST_DAYS * DAY,
                      train_seconds=TRAIN_SECONDS[name], cal_seconds=cal_days * DAY)


def fits_of(spark, sf_dir, name: str, models=MODELS, cal_days: int = 0) -> DataFrame:
    """The fit table of a horizon: every model of every fold with enough rows. Each model is written on its own,
    so that queries of one model and of all share it."""
    def build(model: str) -> DataFrame:
        return walk_forward(feature_table(spark, sf_dir, name), folds_of(spark, sf_dir, name, cal_days), series=SERIES, ts="ts",
                            y=TARGET, features=feature_columns(HORIZONS[name]), models=(model,), min_train=MIN_TRAIN,
                            min_cal=MIN_CAL if cal_days else 0, folds_per_task=1)  # one series here, so folds are the tasks

    out = None
    for model in models:
        own = shared(spark, ("fits", sf_dir, name, model, cal_days), lambda model=model: build(model))
        out = own if out is None else out.unionByName(own)
    return out


def with_benchmarks(spark, sf_dir, name: str, fits: DataFrame) -> DataFrame:
    """Test predictions and both benchmarks, ``(…, ts, y, yhat, naive, operator)``; rows without a benchmark are left out."""
    f = feature_table(spark, sf_dir, name).select(*SERIES, "ts", F.col(PERSISTENCE[name]).alias("naive"), F.col("forecast").alias("operator"))
    return predictions_of(fits, SERIES).join(f, ["series_id", "ts"]).dropna(subset=["naive", "operator"])


@query("i3_ridge_walk_forward")
def q_ridge(spark, sf_dir):
    """Ridge (alpha by exact leave-one-out over logspace(−2, 4, 13)) refitted per fold on the day-ahead table; test predictions."""
    return predictions_of(fits_of(spark, sf_dir, "1d", ("ridge",)), SERIES)


@query("i4_lasso_coefficients")
def q_lasso(spark, sf_dir):
    """I4: LassoCV (four consecutive splits, exact paths) per fold of the week-ahead table."""
    return fits_of(spark, sf_dir, "1w", ("lasso",)).select(
        *SERIES, "fold_id", "model", "intercept", "alpha", "n_train", F.size(F.filter("beta", lambda b: F.abs(b) > 1e-6)).alias("nonzero"))


@query("i5_elasticnet_coefficients")
def q_enet(spark, sf_dir):
    """ElasticNetCV over l1 ratios {.1,.5,.7,.9,.95,.99} per fold of the hour-ahead table."""
    return fits_of(spark, sf_dir, "15min", ("elasticnet",)).select(
        *SERIES, "fold_id", "model", "intercept", "alpha", "l1_ratio", "n_train",
        F.size(F.filter("beta", lambda b: F.abs(b) > 1e-6)).alias("nonzero"))


@query("i6_boosted_trees_walk_forward")
def q_boosted(spark, sf_dir):
    """Boosted trees (500 rounds of depth 3, lr .03, rows and columns .7, min 20 a leaf, λ 5, γ 1) refitted per fold
    of the day-ahead table; test predictions."""
    return predictions_of(fits_of(spark, sf_dir, "1d", ("xgboost",)), SERIES)


@query("i8_walk_forward_metrics")
def q_metrics(spark, sf_dir):
    """I8 + D7: test and mean training MAE, overfit ratio and skill against persistence and the operator's forecast,
    of the four models on the three horizons."""
    out = None
    for name in HORIZONS:
        fits = fits_of(spark, sf_dir, name)
        g = [*SERIES, "model"]
        p = with_benchmarks(spark, sf_dir, name, fits)
        mae = [F.avg(F.abs(F.col(c) - F.col("y"))).alias(c) for c in ("yhat", "naive", "operator")]
        skill = p.groupBy(*g).agg(*mae).select(
            *g, *[(F.try_divide(F.col(b) - F.col("yhat"), F.col(b)) * 100).alias(f"skill_vs_{b}") for b in ("naive", "operator")])
        m = fold_metrics(fits, SERIES).join(skill, g).withColumn("horizon", F.lit(name))
        out = m if out is None else out.unionByName(m)
    return out


@query("i13_model_diagnostics")
def q_model_diagnostics(spark, sf_dir):
    """I13-I20 on the test residuals of every model, day- and week-ahead: Diebold-Mariano against persistence and the
    operator (48 lags), HAC bias test, Ljung-Box (24 and 168), ARCH-LM (48), Jarque-Bera, ADF and KPSS."""
    out = None
    g = [*SERIES, "model"]
    for name in ("1d", "1w"):
        p = with_benchmarks(spark, sf_dir, name, fits_of(spark, sf_dir, name))
        e = cut_lineage(p.select(*g, "ts", *[(F.col(c) - F.col("y")).alias(a) for c, a in
                                             (("yhat", "e"), ("naive", "e_naive"), ("operator", "e_operator"))]))
        ac = cut_lineage(autocovariances(e, g, "ts", "e", max(LJUNG_BOX_LAGS[name], HAC_LAGS)))  # one row per model
        tests = [hac_mean_test(ac, g, HAC_LAGS).drop("z"), ljung_box(ac, g, LJUNG_BOX_LAGS[name]), arch_lm(e, g, "ts", "e", ARCH_LAGS[name]),
                 jarque_bera(e, g, "e").drop("n"), adf_test(e, g, "ts", "e").drop("nobs"), kpss_test(e, g, "ts", "e")]
        tests += [diebold_mariano(e, g, "ts", "e", f"e_{b}", HAC_LAGS).select(
            *g, F.col("dm_stat").alias(f"dm_stat_{b}"), F.col("dm_p").alias(f"dm_p_{b}")) for b in ("naive", "operator")]
        rows = ac.select(*g, "n")
        for t in tests:
            rows = rows.join(t, g)
        rows = rows.withColumn("horizon", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("i21_gated_walk_forward")
def q_gated(spark, sf_dir):
    """I21 wired through I27 and I8: the load and its running sum (less the mean, a random walk) pass the ADF gate; where
    the level is not stationary the models learn ``target − lag24`` and forecasts go back to the level."""
    def build():
        h = hourly_orders(spark, sf_dir)
        mean = h.groupBy("series_id").agg(F.avg("load").alias("mean"))
        walk = h.join(mean, "series_id").select(F.lit("backlog").alias("series_id"), "ts", (F.col("load") - F.col("mean")).alias("x"))
        walk = prefix_sums(walk.withColumn("pos", time_position("ts", HOUR)), SERIES, "pos", ["x"])
        load = h.select("series_id", "ts", "load").unionByName(walk.select("series_id", "ts", F.col("cum_x").alias("load")))
        load = cut_lineage(load)
        weather = h.select("ts", *WEATHER)
        master = load.select("series_id", "ts").join(weather, "ts").select("series_id", "ts", *WEATHER)
        span = h.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(F.explode(F.sequence(
            F.date_sub(F.to_date("a"), 2), F.date_add(F.to_date("b"), 2))).alias("date"))
        off = cut_lineage(days_off_from_dates(spark, span))
        f = build_features(HORIZONS["1d"], load, master, off)
        flags = adf_test(load, SERIES, "ts", "load").select("series_id", (F.col("adf_p") >= 0.05).alias("differenced"))
        gated = cut_lineage(difference_gate(f, flags, SERIES))
        fits = walk_forward(gated, folds_of(spark, sf_dir, "1d"), series=SERIES, ts="ts", y=TARGET,
                            features=feature_columns(HORIZONS["1d"]), models=("ridge", "lasso"), min_train=MIN_TRAIN, folds_per_task=1)
        return undifference(predictions_of(fits, SERIES), gated, SERIES)

    return shared(spark, ("gated", sf_dir), build)


@query("i22_conformal_walk_forward")
def q_conformal(spark, sf_dir):
    """Train < calibration (30 days, 200 rows or more) < test: four models refitted before each calibration block,
    Mondrian widths of their residuals there, intervals of the test block."""
    return conformal_pass(fits_of(spark, sf_dir, "1d", MODELS, CAL_DAYS), SERIES)


def selection(spark, sf_dir) -> DataFrame:
    """``mape, overfit, winkler``, their scores, rank and ``selected`` per model of the day-ahead table."""
    g = [*SERIES, "model"]
    fits = fits_of(spark, sf_dir, "1d")
    mape = forecast_metrics(predictions_of(fits, SERIES), g, "y", "yhat", 0).select(*g, "mape")
    iv = interval_quality(conformal_pass(fits_of(spark, sf_dir, "1d", MODELS, CAL_DAYS), SERIES), g, "y", "lo", "hi", 0.10)
    scores = mape.join(fold_metrics(fits, SERIES).select(*g, "overfit"), g).join(iv.select(*g, "winkler"), g)
    return composite_selection(scores, SERIES, "model", ["mape", "overfit", "winkler"], MODELS)


@query("i23_model_selection")
def q_selection(spark, sf_dir):
    """The model with the best mean of the min-max scores of MAPE, overfit ratio and Winkler score."""
    return selection(spark, sf_dir)


@query("i24_learning_curve")
def q_learning(spark, sf_dir):
    """Training and validation MAE of each model trained on the last {30…700} days before the last 45 days;
    windows below 500 rows are skipped, ``selected`` marks I23's choice."""
    def build():
        end = hourly_orders(spark, sf_dir).agg(F.max("ts").cast("string")).first()[0]
        windows = learning_curve_windows(spark, end, LEARNING_DAYS, VALID_DAYS)
        fits = cut_lineage(walk_forward(feature_table(spark, sf_dir, "1d"), windows.drop("days"), series=SERIES, ts="ts", y=TARGET,
                                        features=feature_columns(HORIZONS["1d"]), min_train=LEARNING_MIN, folds_per_task=1))
        valid = predictions_of(fits, SERIES).groupBy(*SERIES, "model", "fold_id").agg(
            F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col("yhat") - F.col("y"))).alias("mae"))
        return (valid.join(fits.select(*SERIES, "model", "fold_id", "train_mae"), [*SERIES, "model", "fold_id"])
                .join(F.broadcast(windows.select("fold_id", "days")), "fold_id").drop("fold_id"))

    curve = shared(spark, ("learning", sf_dir), build)
    return curve.join(selection(spark, sf_dir).select(*SERIES, "model", "selected"), [*SERIES, "model"])


@query("i12_significant_features")
def q_significant(spark, sf_dir):
    """Which predictors of the day-ahead table matter, from fits on all its rows: OLS-HAC p (48 lags), non-zero
    lasso and elastic-net coefficients, importances of 500 boosted trees, correlations with the target."""
    cols = feature_columns(HORIZONS["1d"])

    def build():
        f = feature_table(spark, sf_dir, "1d").dropna(subset=[TARGET, *cols])
        ends = f.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
        hour = F.make_dt_interval(F.lit(0), F.lit(1))
        span = ends.select(F.lit(1).alias("fold_id"), F.col("a").alias("train_start"), (F.col("b") + hour).alias("cal_start"),
                           F.col("b").alias("test_start"), (F.col("b") + hour).alias("test_end"))
        fits = cut_lineage(walk_forward(f, span, series=SERIES, ts="ts", y=TARGET, features=cols,
                                        models=("lasso", "elasticnet", "xgboost"), min_train=MIN_TRAIN, folds_per_task=1))
        names = F.array(*[F.lit(c) for c in cols])
        gains = fits.where("model = 'xgboost'").select("model", F.posexplode("importance").alias("i", "importance")).select(
            "model", F.element_at(names, F.col("i") + 1).alias("feature"), "importance")
        ols = ols_hac(f, SERIES, "ts", TARGET, [c for c in cols if c not in HORIZONS["1d"].diffs], HAC_LAGS)
        return significant_features(ols, fits.where("beta IS NOT NULL").select("model", "fold_id", "beta"), gains, cols,
                                    correlations(f, TARGET, cols))

    return shared(spark, ("significant", sf_dir), build)
