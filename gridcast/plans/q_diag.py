"""Group I diagnostics queries (I10-I21) on residuals of the persistence models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import correlations
from ..operators.timegrid import drop_empty_columns_fill_zero
from ..session import cut_lineage
from .diagnostics import (acf_column, adf_test, arch_lm, autocovariances, diebold_mariano, hac_mean_test,
                          jarque_bera, kpss_test, ljung_box, ols_hac, prune_features)
from .q_aggs import SQL_PRED, predictions, wide_predictions
from .features import HORIZONS, build_features, difference_gate, feature_columns
from .q_model import hourly_inputs
from .inputs import event_hourly
from .registry import Tables, query

G = ["series_id", "model"]
ACF_LAGS = 24


def residuals(t):
    return predictions(t).withColumn("e", F.col("yhat") - F.col("y"))


_ACF_SQL = f"""
WITH {SQL_PRED},
e AS (SELECT series_id, model, ts, yhat - y AS e FROM p),
m AS (SELECT series_id, model, avg(e) AS mu FROM e GROUP BY 1, 2),
cc AS (SELECT e.series_id, e.model, ts, e - mu AS c FROM e JOIN m USING (series_id, model)),
lg2 AS (SELECT *, {", ".join(f"lag(c, {k}) OVER (PARTITION BY series_id, model ORDER BY ts) AS l{k}" for k in range(1, ACF_LAGS + 1))}
      FROM cc)
SELECT series_id, model, {", ".join(f"sum(c * l{k}) / sum(c * c) AS acf{k}" for k in range(1, ACF_LAGS + 1))}
FROM lg2 GROUP BY 1, 2"""


@query("i15_residual_acf", _ACF_SQL, doubles=[f"acf{k}" for k in range(1, ACF_LAGS + 1)])
def q_acf(spark, sf_dir):
    """Residual autocorrelation at lags 1..24 (positional, mean-centred)."""
    ac = autocovariances(residuals(Tables(spark, sf_dir)), G, "ts", "e", ACF_LAGS)
    return ac.select(*G, *[acf_column(k).alias(f"acf{k}") for k in range(1, ACF_LAGS + 1)])


@query("i16_ljung_box")
def q_lb(spark, sf_dir):
    """I16: Ljung–Box Q(24) and its χ² p-value per series and model."""
    ac = autocovariances(residuals(Tables(spark, sf_dir)), G, "ts", "e", ACF_LAGS)
    return ljung_box(ac, G, ACF_LAGS)


@query("i18_jarque_bera", f"""
WITH {SQL_PRED},
e AS (SELECT series_id, model, yhat - y AS e FROM p),
m AS (SELECT series_id, model, avg(e) AS mu, count(*) AS n FROM e GROUP BY 1, 2),
k AS (SELECT series_id, model, n, avg(power(e - mu, 2)) AS m2, avg(power(e - mu, 3)) AS m3, avg(power(e - mu, 4)) AS m4
      FROM e JOIN m USING (series_id, model) GROUP BY 1, 2, 3),
j AS (SELECT series_id, model, n, n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4) AS jb FROM k)
SELECT series_id, model, n, jb, exp(-jb / 2) AS jb_p FROM j""", doubles=["jb", "jb_p"])
def q_jb(spark, sf_dir):
    """Jarque–Bera normality statistic and p-value."""
    return jarque_bera(residuals(Tables(spark, sf_dir)), G, "e")


@query("i13_diebold_mariano")
def q_dm(spark, sf_dir):
    """Diebold–Mariano (absolute loss, Newey–West 48) of each model against lag-24 persistence."""
    w = wide_predictions(Tables(spark, sf_dir))
    long = w.select("series_id", "ts", (F.col("naive24") - F.col("y")).alias("e_bench"),
                    *[(F.col(m) - F.col("y")).alias(m) for m in ("naive168", "mean24")]).unpivot(
        ["series_id", "ts", "e_bench"], ["naive168", "mean24"], "model", "e")
    return diebold_mariano(long, G, "ts", "e", "e_bench", 48)


_DM_LAGS = 48
_BENCHMARKS = {"naive": "naive24", "operator": "operator"}
_BENCH_SQL = f"""
WITH {SQL_PRED},
o AS (SELECT ts, sum(value) / 5 AS operator FROM h GROUP BY ts),
x AS (SELECT p.series_id, p.model, p.ts, p.yhat - p.y AS e, c.naive24 - p.y AS e_naive, o.operator - p.y AS e_operator
      FROM p JOIN c USING (series_id, ts) JOIN o USING (ts) WHERE p.model <> 'naive24'),
d AS (SELECT series_id, model, ts, e, b, eb, abs(e) - abs(eb) AS d FROM (
  SELECT series_id, model, ts, e, 'naive' AS b, e_naive AS eb FROM x UNION ALL SELECT series_id, model, ts, e, 'operator', e_operator FROM x)),
m AS (SELECT *, d - avg(d) OVER (PARTITION BY series_id, model, b) AS c FROM d),
z AS (SELECT *, {", ".join(f"lag(c, {k}) OVER w AS l{k}" for k in range(1, _DM_LAGS + 1))} FROM m WINDOW w AS (PARTITION BY series_id, model, b ORDER BY ts)),
s AS (SELECT series_id, model, b, count(*) AS n, avg(abs(e)) AS mae, avg(abs(eb)) AS mae_benchmark, avg(d) AS mean, (sum(c * c)
      + 2 * ({" + ".join(f"{1 - k / (_DM_LAGS + 1)} * coalesce(sum(c * l{k}), 0)" for k in range(1, _DM_LAGS + 1))})) / count(*) AS v FROM z GROUP BY 1, 2, 3)
SELECT series_id, model, b AS benchmark, n, mae, (mae_benchmark - mae) / mae_benchmark * 100 AS skill, mean / sqrt(v / n) AS dm_stat FROM s"""


@query("e9_external_benchmark", _BENCH_SQL, doubles=["mae", "skill", "dm_stat"])
def q_external(spark, sf_dir):
    """Each model against two benchmarks, persistence (lag 24) and an external one (the mean of all series, as an
    operator's forecast), on the hours that all have: MAE, skill and the Diebold-Mariano statistic (48 lags)."""
    t = Tables(spark, sf_dir)
    operator = event_hourly(t).groupBy("ts").agg((F.sum("value") / 5).alias("operator"))
    w = cut_lineage(wide_predictions(t).join(operator, "ts"))  # written once: errors against both benchmarks
    models = ["naive168", "mean24"]
    long = w.select("series_id", "ts", "y", *[F.col(c).alias(f"_{b}") for b, c in _BENCHMARKS.items()], *models).unpivot(
        ["series_id", "ts", "y", *[f"_{b}" for b in _BENCHMARKS]], models, "model", "yhat")
    errors = long.unpivot(["series_id", "ts", "y", "model", "yhat"], [f"_{b}" for b in _BENCHMARKS], "benchmark", "yb").select(
        "series_id", "model", F.substring("benchmark", 2, 20).alias("benchmark"), "ts", (F.col("yhat") - F.col("y")).alias("e"),
        (F.col("yb") - F.col("y")).alias("e_b"))
    g = [*G, "benchmark"]
    mae = errors.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs("e")).alias("mae"), F.avg(F.abs("e_b")).alias("mae_b"))
    skill = mae.select(*g, "n", "mae", ((F.col("mae_b") - F.col("mae")) / F.col("mae_b") * 100).alias("skill"))
    return skill.join(diebold_mariano(errors, g, "ts", "e", "e_b", _DM_LAGS).drop("dm_p"), g)


@query("i14_bias_test_hac")
def q_bias(spark, sf_dir):
    """Is the mean error zero? HAC (Bartlett, 48 lags) z-test."""
    ac = autocovariances(residuals(Tables(spark, sf_dir)), G, "ts", "e", 48)
    return hac_mean_test(ac, G, 48)


@query("i17_arch_lm")
def q_arch(spark, sf_dir):
    """ARCH-LM test with 24 lags of squared residuals."""
    return arch_lm(residuals(Tables(spark, sf_dir)), G, "ts", "e", 24)


@query("i19_adf")
def q_adf(spark, sf_dir):
    """Augmented Dickey–Fuller (constant, AIC lag order) on residuals."""
    return adf_test(residuals(Tables(spark, sf_dir)), G, "ts", "e")


@query("i20_kpss")
def q_kpss(spark, sf_dir):
    """KPSS level-stationarity test (automatic bandwidth) on residuals."""
    return kpss_test(residuals(Tables(spark, sf_dir)), G, "ts", "e")


def _inference(spark, t, name):
    """The I27 table of a horizon, written once, and its predictors for OLS: without the exact
    combinations of other lags and without lags that reach back beyond the whole table."""
    h = HORIZONS[name]
    cols = [c for c in feature_columns(h) if c not in h.diffs]
    f = cut_lineage(build_features(h, *hourly_inputs(spark, t)))
    kept = drop_empty_columns_fill_zero(f, cols).columns
    return f, [c for c in cols if c in kept]


@query("i10_ols_hac_pvalues")
def q_ols(spark, sf_dir):
    """OLS on the standardised day-ahead feature table with Bartlett-HAC (48 lags) p-values."""
    f, cols = _inference(spark, Tables(spark, sf_dir), "1d")
    return ols_hac(f, ["series_id"], "ts", "load_actual_mw", cols, 48)


@query("i11_feature_pruning")
def q_prune(spark, sf_dir):
    """Week-ahead table, HAC with 168 lags: keep a feature unless p ≥ 0.05 and
    |corr with target| < 0.20, per series."""
    f, cols = _inference(spark, Tables(spark, sf_dir), "1w")
    p = ols_hac(f, ["series_id"], "ts", "load_actual_mw", cols, 168).filter(F.col("feature") != "const")
    c = correlations(f.dropna(subset=["load_actual_mw", *cols]), "load_actual_mw", cols, ["series_id"])
    return prune_features(p, c, on=["series_id", "feature"])


@query("i21_difference_gate")
def q_gate(spark, sf_dir):
    """ADF on the level; non-stationary series get the target Δ24 = y − lag24."""
    t = Tables(spark, sf_dir)
    w = wide_predictions(t).select("series_id", "ts", F.col("y").alias("load_actual_mw"),
                                   F.col("naive24").alias("lag24"))
    adf = adf_test(w, ["series_id"], "ts", "load_actual_mw").select("series_id", "adf_p")
    flags = adf.select("series_id", (F.col("adf_p") >= 0.05).alias("differenced"))
    return difference_gate(w, flags).select("series_id", "ts", "load_actual_mw", "differenced")
