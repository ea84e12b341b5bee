"""Residual diagnostics and inference from distributed sufficient statistics.

Each test is reduced to sums computed by Spark over all rows (positional
autocovariances from one bucket+halo window pass, Gram tables of lag
matrices); only per-group scalars / k×k arrays reach the finishing step, which
runs as a vectorised pandas UDF or an ``applyInPandas`` per group.

Fixed values (must match the reference's statistics libraries):
MacKinnon (1994) surface for the ADF test with a constant, one series:
tau_max 2.74, tau_min −18.83, tau_star −1.61, small-p polynomial
[2.1659, 1.4412, 0.038269], large-p polynomial [1.7339, 0.93202, −0.12745,
−0.010368] (p = Φ(polynomial in tau)); KPSS (constant) critical values
0.347, 0.463, 0.574, 0.739 at p = 0.10, 0.05, 0.025, 0.01.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import Lookback, lookback_features, position_index
from ..session import cut_lineage
from .linear import gram_of_arrays

# --- fixed values (see module docstring) ------------------------------------------------
MACKINNON_C = {"tau_max": 2.74, "tau_min": -18.83, "tau_star": -1.61,
               "small": (2.1659, 1.4412, 0.038269), "large": (1.7339, 0.93202, -0.12745, -0.010368)}
KPSS_C_CRIT = ((0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01))
# -----------------------------------------------------------------------------------------


# --- scalar distribution helpers (used inside pandas UDFs) --------------------------------

def norm_cdf(z):
    return 0.5 * np.vectorize(math.erfc)(-np.asarray(z, float) / math.sqrt(2))


def chi2_sf(x, k):
    """Survival function of χ²(k) via the regularised upper incomplete gamma Q(k/2, x/2)."""
    def q(a, xx):
        if xx <= 0:
            return 1.0
        if xx < a + 1:  # series for P
            s, term, n = 1.0 / a, 1.0 / a, 0
            while abs(term) > 1e-15 * abs(s) and n < 10000:
                n += 1
                term *= xx / (a + n)
                s += term
            return max(0.0, 1.0 - s * math.exp(-xx + a * math.log(xx) - math.lgamma(a)))
        b, c, d = xx + 1 - a, 1e300, 1 / (xx + 1 - a)  # continued fraction for Q
        h = d
        for i in range(1, 10000):
            an = -i * (i - a)
            b += 2
            d = an * d + b
            d = 1e-300 if abs(d) < 1e-300 else d
            c = b + an / c
            c = 1e-300 if abs(c) < 1e-300 else c
            d = 1 / d
            de = d * c
            h *= de
            if abs(de - 1) < 1e-15:
                break
        return math.exp(-xx + a * math.log(xx) - math.lgamma(a)) * h
    return np.array([q(kk / 2.0, xx / 2.0) if np.isfinite(xx) else np.nan
                     for xx, kk in zip(np.atleast_1d(np.asarray(x, float)), np.broadcast_to(k, np.shape(np.atleast_1d(x))))])


def mackinnon_p(tau):
    tau = np.asarray(tau, float)
    m = MACKINNON_C
    small = np.polyval(m["small"][::-1], tau)
    large = np.polyval(m["large"][::-1], tau)
    p = norm_cdf(np.where(tau <= m["tau_star"], small, large))
    return np.where(tau > m["tau_max"], 1.0, np.where(tau < m["tau_min"], 0.0, p))


def kpss_p(stat):
    crit = np.array([c for c, _ in KPSS_C_CRIT])
    pv = np.array([p for _, p in KPSS_C_CRIT])
    return np.interp(np.asarray(stat, float), crit, pv)


# --- I15: positional autocovariances ---------------------------------------------------------

def centred(df: DataFrame, group: Sequence[str], ts: str, x: str, demean: bool = True) -> DataFrame:
    """``(group…, pos, n, mean, _c)`` with ``_c = x − mean`` (or ``x``) and dense positions, written once:
    the passes of a test read it from there."""
    g = list(group)
    if not g:
        raise ValueError("centred needs at least one group column")
    d = df.select(*g, ts, F.col(x).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    d = cut_lineage(d)  # the mean, the offsets and the rows themselves are three reads
    mean = d.groupBy(*g).agg(F.avg("_x").alias("mean"), F.count(F.lit(1)).alias("n"))
    c = position_index(d, g, [ts]).join(mean, g)
    return c.select(*g, "pos", "n", "mean", (F.col("_x") - F.col("mean") if demean else F.col("_x")).alias("_c"))


def autocovariances(df: DataFrame, group: Sequence[str], ts: str, x: str, max_lag: int,
                    demean: bool = True) -> DataFrame:
    """Per group: ``n, mean, s0 = Σc², ac[l] = Σ c_t c_{t−l}`` (l = 1..max_lag), with
    ``c = x − mean`` (or ``x``). Positional lags; one windowed pass + one aggregation."""
    return _autocovariances(centred(df, group, ts, x, demean), group, max_lag)


def _autocovariances(c: DataFrame, group: Sequence[str], max_lag: int) -> DataFrame:
    g = list(group)
    w = lookback_features(c, g, "pos", Lookback().history("_h", "_c", max_lag))
    aggs = [F.first("n").alias("n"), F.first("mean").alias("mean"), F.sum(F.col("_c") * F.col("_c")).alias("s0")]
    aggs.append(F.array(*[F.coalesce(F.sum(F.col("_c") * F.get("_h", F.lit(lag - 1))), F.lit(0.0))
                          for lag in range(1, max_lag + 1)]).alias("ac"))
    return w.groupBy(*g).agg(*aggs)


def acf_column(lag: int) -> Column:
    """ACF at ``lag`` from an :func:`autocovariances` row."""
    return F.try_divide(F.col("ac")[lag - 1], F.col("s0"))


def newey_west_var(max_lag: int) -> Column:
    """Bartlett long-run variance ``(s0 + 2Σ(1 − l/(L+1)) ac_l) / n`` (demeaned)."""
    terms = F.aggregate(F.transform(F.slice("ac", 1, max_lag), lambda v, i: (1 - (i + 1) / (max_lag + 1)) * v),
                        F.lit(0.0), lambda a, b: a + b)
    return (F.col("s0") + 2 * terms) / F.col("n")


@F.pandas_udf(T.DoubleType())
def _chi2_sf_udf(x: pd.Series, k: pd.Series) -> pd.Series:
    return pd.Series(chi2_sf(x.to_numpy(), k.to_numpy()))


@F.pandas_udf(T.DoubleType())
def _two_sided_normal_p(z: pd.Series) -> pd.Series:
    return pd.Series(2 * (1 - norm_cdf(np.abs(z.to_numpy()))))


def ljung_box(ac: DataFrame, group: Sequence[str], lags: int) -> DataFrame:
    """I16: Q = n(n+2) Σ ρ_l² / (n − l), p = χ²_h tail."""
    q = F.col("n") * (F.col("n") + 2) * F.aggregate(
        F.transform(F.slice("ac", 1, lags), lambda v, i: F.pow(v / F.col("s0"), 2) / (F.col("n") - i - 1)),
        F.lit(0.0), lambda a, b: a + b)
    return ac.select(*group, q.alias("lb_stat")).withColumn("lb_p", _chi2_sf_udf(F.col("lb_stat"), F.lit(float(lags))))


def hac_mean_test(ac: DataFrame, group: Sequence[str], max_lag: int, out: str = "bias_p") -> DataFrame:
    """I14 (bias test) / I13 (DM on a loss differential): z = mean / sqrt(NW(L)/n), two-sided normal p."""
    z = F.col("mean") / F.sqrt(newey_west_var(max_lag) / F.col("n"))
    return ac.select(*group, z.alias("z")).withColumn(out, _two_sided_normal_p(F.col("z")))


def diebold_mariano(errors: DataFrame, group: Sequence[str], ts: str, e1: str, e2: str, max_lag: int = 48) -> DataFrame:
    """DM test on the absolute-loss differential |e1| − |e2| with Newey–West variance."""
    d = errors.withColumn("_d", F.abs(F.col(e1)) - F.abs(F.col(e2)))
    ac = autocovariances(d, group, ts, "_d", max_lag)
    return hac_mean_test(ac, group, max_lag, "dm_p").withColumnRenamed("z", "dm_stat")


def jarque_bera(df: DataFrame, group: Sequence[str], x: str) -> DataFrame:
    """JB = n/6 (S² + (K−3)²/4) with biased moments; p = exp(−JB/2) (χ²₂ tail)."""
    a = df.groupBy(*group).agg(F.count(x).alias("n"), F.skewness(x).alias("skew"), F.kurtosis(x).alias("exkurt"))
    jb = F.col("n") / 6 * (F.pow("skew", 2) + F.pow("exkurt", 2) / 4)
    return a.select(*group, "n", jb.alias("jb"), F.exp(-jb / 2).alias("jb_p"))


# --- Gram-based regressions on lag matrices (I17, I19, I10) ------------------------------------

def _lagged(df, group, ts, x, lags):
    """``x`` less its group mean as ``_x`` (a regression with a constant is the same, and its raw
    sums of squares do not cancel), with its position and its last ``lags`` values as array ``_h``."""
    g = list(group) or ["_all"]
    d = df if group else df.withColumn("_all", F.lit(1))
    d = d.select(*g, ts, F.col(x).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    mean = d.groupBy(*g).agg(F.avg("_x").alias("_mean"))
    d = d.join(mean, g).withColumn("_x", F.col("_x") - F.col("_mean")).drop("_mean")
    return lookback_features(position_index(d, g, [ts]), g, "pos", Lookback().history("_h", "_x", lags)), g


def _ols_from_gram(gpdf: pd.Series, k: int):
    iu = np.triu_indices(k)
    s = np.zeros((k, k))
    s[iu] = np.asarray(gpdf["sxx"], float)
    s = s + s.T - np.diag(np.diag(s))
    return s


def arch_lm(df: DataFrame, group: Sequence[str], ts: str, e: str, q: int = 48) -> DataFrame:
    """Regress e²_t on [1, e²_{t−1..t−q}]; LM = (n − q)·R², p = χ²_q tail."""
    d, g = _lagged(df.withColumn("_e2", F.col(e) * F.col(e)), group, ts, "_e2", q)
    gram = gram_of_arrays(d.filter(F.col("pos") >= q), g, "_h", "_x", q)
    schema = T.StructType([gram.schema[c] for c in g] + [T.StructField("arch_lm", T.DoubleType()),
                                                          T.StructField("arch_p", T.DoubleType())])

    def fin(p: pd.DataFrame) -> pd.DataFrame:
        r = p.iloc[0]
        k = q + 1
        n = float(r["n"])
        sx = np.concatenate([[n], np.asarray(r["sx"], float)])
        xx = np.zeros((k, k))
        xx[0, :] = sx
        xx[:, 0] = sx
        xx[1:, 1:] = _ols_from_gram(r, q)
        xy = np.concatenate([[r["sy"]], np.asarray(r["sxy"], float)])
        sst = r["syy"] - r["sy"] ** 2 / n
        beta = np.linalg.lstsq(xx, xy, rcond=None)[0]
        ssr = r["syy"] - 2 * beta @ xy + beta @ xx @ beta
        lm = n * (1 - ssr / sst) if sst > 0 else float("nan")
        out = {c: r[c] for c in g}
        out.update(arch_lm=float(lm), arch_p=float(chi2_sf([lm], q)[0]))
        return pd.DataFrame([out])

    res = gram.groupBy(*g).applyInPandas(fin, schema)
    return res.drop("_all") if not group else res


def adf_test(df: DataFrame, group: Sequence[str], ts: str, x: str, max_lag: int | None = None) -> DataFrame:
    """Augmented Dickey–Fuller with a constant; lag order by AIC over the
    common sample, t-statistic on the chosen order's own sample, MacKinnon p.

    One pass: rows get ``key = min(pos, max_lag + 1)`` (how many lagged
    differences exist for them) and unavailable lags are zero; a Gram keyed by
    (group, key) gives the common-sample Gram (key = max_lag + 1) and the Gram of
    any order p (keys ≥ p + 1, leading 2 + p block). ``max_lag`` defaults to
    ``ceil(12 (n/100)^{1/4})``, at most ``n/2 - 2``, with each group's own n.
    """
    own_lag = max_lag is None

    def default_lag(n: int) -> int:
        return max(0, min(int(math.ceil(12 * (n / 100.0) ** 0.25)), n // 2 - 2))

    if own_lag:
        max_lag = default_lag(_largest_group(df, group, x))
    d, g = _lagged(df, group, ts, x, max_lag + 1)
    before = F.get("_h", F.lit(0))
    later = F.concat(F.slice("_h", 2, max_lag), F.array_repeat(F.lit(None).cast("double"), max_lag))
    steps = F.transform(F.slice(F.zip_with(F.col("_h"), later, lambda a, b: a - b), 1, max_lag),
                        lambda v: F.coalesce(v, F.lit(0.0)))
    padded = F.slice(F.concat(F.array(before), steps, F.array_repeat(F.lit(0.0), max_lag)), 1, max_lag + 1)
    w = d.filter(F.col("pos") >= 1).select(*g, F.least(F.col("pos"), F.lit(max_lag + 1)).alias("_k"),
                                           (F.col("_x") - before).alias("_dy"), padded.alias("_f"))
    kf = max_lag + 1
    gram = gram_of_arrays(w, [*g, "_k"], "_f", "_dy", kf)
    schema = T.StructType([gram.schema[c] for c in g] + [T.StructField("used_lag", T.IntegerType()),
                                                         T.StructField("adf_stat", T.DoubleType()),
                                                         T.StructField("adf_p", T.DoubleType()),
                                                         T.StructField("nobs", T.LongType())])

    def summed(rows):
        return pd.Series({"n": rows["n"].sum(), "sy": rows["sy"].sum(), "syy": rows["syy"].sum(),
                          "sx": np.stack(rows["sx"].to_numpy()).sum(0), "sxy": np.stack(rows["sxy"].to_numpy()).sum(0),
                          "sxx": np.stack(rows["sxx"].to_numpy()).sum(0)})

    def fin(p: pd.DataFrame) -> pd.DataFrame:
        most = default_lag(int(p["n"].sum()) + 1) if own_lag else max_lag
        common = p[p["_k"] >= most + 1]
        if len(common) == 0:
            return pd.DataFrame(columns=schema.names)
        r = summed(common)
        xx, xy, n = _design(r, kf)
        best = None
        for lag in range(0, most + 1):
            k = 2 + lag
            b = np.linalg.lstsq(xx[:k, :k], xy[:k], rcond=None)[0]
            ssr = r["syy"] - 2 * b @ xy[:k] + b @ xx[:k, :k] @ b
            aic = n * (math.log(2 * math.pi) + math.log(max(ssr, 1e-300) / n) + 1) + 2 * k
            if best is None or aic < best[0]:
                best = (aic, lag)
        lag = best[1]
        r2 = summed(p[p["_k"] >= lag + 1])
        xx, xy, n = _design(r2, kf)
        k = 2 + lag
        xx, xy = xx[:k, :k], xy[:k]
        inv = np.linalg.pinv(xx)
        b = inv @ xy
        ssr = r2["syy"] - 2 * b @ xy + b @ xx @ b
        t = b[1] / math.sqrt(ssr / (n - k) * inv[1, 1])
        out = {c: p[c].iloc[0] for c in g}
        out.update(used_lag=int(lag), adf_stat=float(t), adf_p=float(mackinnon_p(t)), nobs=int(n))
        return pd.DataFrame([out])

    res = gram.groupBy(*g).applyInPandas(fin, schema)
    return res.drop("_all") if not group else res


def _design(r, kf):
    """[1, features] cross products from a Gram row."""
    n = float(r["n"])
    k = kf + 1
    xx = np.zeros((k, k))
    xx[0, 0] = n
    sx = np.asarray(r["sx"], float)
    xx[0, 1:] = sx
    xx[1:, 0] = sx
    iu = np.triu_indices(kf)
    s = np.zeros((kf, kf))
    s[iu] = np.asarray(r["sxx"], float)
    xx[1:, 1:] = s + s.T - np.diag(np.diag(s))
    xy = np.concatenate([[float(r["sy"])], np.asarray(r["sxy"], float)])
    return xx, xy, n


def _largest_group(df: DataFrame, group: Sequence[str], x: str) -> int:
    """Rows of the largest group with ``x``: one number, which bounds how many lags are planned."""
    return df.filter(F.col(x).isNotNull()).groupBy(*group).count().agg(F.max("count")).first()[0] or 0


def kpss_test(df: DataFrame, group: Sequence[str], ts: str, x: str) -> DataFrame:
    """KPSS (constant) with the automatic bandwidth of Hobijn et al.; p from the
    critical-value table, clipped to [0.01, 0.10].

    η = Σ S_t² / (n² σ²), S_t the partial sums of the demeaned series (bucketed
    prefix sums), σ² the Bartlett long-run variance at the automatic lag. The lag of each
    group is computed first, from its own n; the second pass has as many lags as the
    longest needs. A constant series has no statistic (NaN)."""
    from ..operators.windows import prefix_sums
    g = list(group) or ["_all"]
    d = df if group else df.withColumn("_all", F.lit(1))
    c = cut_lineage(centred(d, g, ts, x))  # two passes of autocovariances and the partial sums read it
    longest = c.agg(F.max("n")).first()[0] or 0  # one number, which bounds how many lags are planned
    first = _autocovariances(c, g, max(1, int(longest ** (2.0 / 9.0))))
    head = F.slice("ac", 1, F.floor(F.pow("n", F.lit(2.0 / 9.0))).cast("int"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, b: a + b)
    s0 = F.col("s0") + 2 * total(head)
    s1 = 2 * total(F.transform(head, lambda v, i: (i + 1) * v))
    lag = F.floor(1.1447 * F.pow(F.pow(F.try_divide(s1, s0), 2) * F.col("n"), F.lit(1.0 / 3.0)))
    lags = cut_lineage(first.select(*g, F.least(F.coalesce(lag, F.lit(0)), F.col("n") - 1).cast("int").alias("lags")))
    ac = _autocovariances(c, g, max(1, lags.agg(F.max("lags")).first()[0] or 0)).join(lags, g)
    ps = prefix_sums(c.select(*g, "pos", "_c"), g, "pos", ["_c"])
    eta_num = ps.groupBy(*g).agg(F.sum(F.col("cum__c") * F.col("cum__c")).alias("ss"))
    j = ac.join(eta_num, g)
    schema = T.StructType([j.schema[cn] for cn in g] + [T.StructField("kpss_stat", T.DoubleType()),
                                                        T.StructField("kpss_lags", T.IntegerType()),
                                                        T.StructField("kpss_p", T.DoubleType())])

    def fin(p: pd.DataFrame) -> pd.DataFrame:
        r = p.iloc[0]
        n = float(r["n"])
        acv = np.asarray(r["ac"], float)
        s0 = float(r["s0"])
        lags = int(r["lags"])
        s2 = (s0 + 2 * (1 - np.arange(1, lags + 1) / (lags + 1.0)) @ acv[:lags]) / n
        eta = float(r["ss"]) / (n * n * s2) if s2 > 0 else float("nan")
        out = {cn: r[cn] for cn in g}
        out.update(kpss_stat=eta, kpss_lags=int(lags), kpss_p=float(np.clip(kpss_p(eta), 0.01, 0.10)))
        return pd.DataFrame([out])

    res = j.groupBy(*g).applyInPandas(fin, schema)
    return res.drop("_all") if not group else res


def ols_hac(df: DataFrame, group: Sequence[str], ts: str, y: str, features: Sequence[str], max_lag: int = 48) -> DataFrame:
    """OLS of y on [1, z] (z standardised, ddof 1) with Bartlett-HAC standard errors.

    Pass 1: Gram → β per group. Pass 2: with score vectors s_t = u_t·[1, z_t] and zeros
    around them, Σ_l (1 − |l|/(L+1)) Σ_t s_t s_{t−l}ᵀ = Σ_τ B_τ B_τᵀ / (L+1), where B_τ is the
    sum of the L+1 scores up to τ. So one rolling sum per score and the Gram of the rolling
    sums serve any L. Output: one row per (group, feature) with coef, se and two-sided normal
    p (no small-sample correction). Rows with a NULL are left out; ``ts`` is unique in a group.
    """
    g = list(group) or ["_all"]
    d = df if group else df.withColumn("_all", F.lit(1))
    # the features as one array: dozens of columns in each step would make planning slow
    x = F.array(*[F.col(f).cast("double") for f in features])
    d = d.select(*g, ts, F.col(y).cast("double").alias("_y"), x.alias("_x")).filter(
        F.col("_y").isNotNull() & ~F.exists("_x", lambda v: v.isNull()))
    at = [F.get("_x", F.lit(i)) for i in range(len(features))]
    st = d.groupBy(*g).agg(F.avg("_y").alias("_mean"), F.array(*[F.avg(c) for c in at]).alias("_m"),
                           F.array(*[F.stddev_samp(c) for c in at]).alias("_s"))
    scaled = F.transform("_x", lambda v, i: F.coalesce(F.try_divide(v - F.get("_m", i), F.get("_s", i)), F.lit(0.0)))
    # the target less its mean: the constant gets it back at the end
    z = d.join(st, g).select(*g, ts, (F.col("_y") - F.col("_mean")).alias("_y"), scaled.alias("_z"))
    kf = len(features)
    gram = gram_of_arrays(z, g, "_z", "_y", kf)
    coef_schema = T.StructType([gram.schema[c] for c in g] + [T.StructField("beta", T.ArrayType(T.DoubleType())),
                                                              T.StructField("xtx_inv", T.ArrayType(T.DoubleType())),
                                                              T.StructField("rows", T.LongType())])

    def solve(p: pd.DataFrame) -> pd.DataFrame:
        r = p.iloc[0]
        xx, xy, _ = _design(r, kf)
        inv = np.linalg.pinv(xx)
        out = {c: r[c] for c in g}
        out.update(beta=[float(v) for v in inv @ xy], xtx_inv=[float(v) for v in inv.ravel()], rows=int(r["n"]))
        return pd.DataFrame([out])

    coefs = cut_lineage(gram.groupBy(*g).applyInPandas(solve, coef_schema))  # one row per group, read three times
    u = F.col("_y") - F.aggregate(F.zip_with("beta", "_one_z", lambda b, v: b * v), F.lit(0.0), lambda a, b: a + b)
    sc = (z.join(coefs.select(*g, "beta"), g).withColumn("_one_z", F.concat(F.array(F.lit(1.0)), "_z"))
          .withColumn("_u", u).select(*g, ts, F.transform("_one_z", lambda v: v * F.col("_u")).alias("_score")))
    sc = position_index(sc, g, [ts]).select(*g, "pos", "_score")
    after = coefs.select(*g, F.explode(F.sequence(F.col("rows"), F.col("rows") + max_lag - 1)).alias("pos"),
                         F.array_repeat(F.lit(0.0), kf + 1).alias("_score"))
    rolled = (sc.unionByName(after) if max_lag else sc).select(
        *g, "pos", *[F.get("_score", F.lit(i)).alias(f"_s{i}") for i in range(kf + 1)])
    spec = Lookback()
    for i in range(kf + 1):
        spec.rolling_sum(f"_b{i}", f"_s{i}", max_lag, 0)
    w = lookback_features(rolled, g, "pos", spec)
    w = w.select(*g, F.array(*[f"_b{i}" for i in range(kf + 1)]).alias("_b"), F.col("_b0").alias("_y"))
    meat = gram_of_arrays(w, g, "_b", "_y", kf + 1).select(*g, "sxx")
    res_schema = T.StructType([gram.schema[c] for c in g] + [T.StructField("feature", T.StringType()),
                                                             T.StructField("coef", T.DoubleType()),
                                                             T.StructField("se", T.DoubleType()),
                                                             T.StructField("p", T.DoubleType())])
    names = ["const", *features]

    def finish(p: pd.DataFrame) -> pd.DataFrame:
        r = p.iloc[0]
        k = kf + 1
        s = _ols_from_gram(r, k) / (max_lag + 1.0)
        inv = np.asarray(r["xtx_inv"], float).reshape(k, k)
        v = inv @ s @ inv
        beta = np.array(r["beta"], float)
        beta[0] += r["_mean"]
        se = np.sqrt(np.clip(np.diag(v), 0, None))
        zz = np.where(se > 0, beta / np.where(se > 0, se, 1), np.nan)
        pv = 2 * (1 - norm_cdf(np.abs(zz)))
        rows = [{**{c: r[c] for c in g}, "feature": names[i], "coef": float(beta[i]), "se": float(se[i]),
                 "p": float(pv[i])} for i in range(k)]
        return pd.DataFrame(rows)

    res = (meat.join(coefs, g).join(st.select(*g, "_mean"), g)
           .groupBy(*g).applyInPandas(finish, res_schema))
    return res.drop("_all") if not group else res


def prune_features(pvalues: DataFrame, corr: DataFrame, p_max: float = 0.05, corr_min: float = 0.20,
                   on: Sequence[str] = ("feature",)) -> DataFrame:
    """Drop a feature when p ≥ 0.05 **and** |corr with target| < 0.20.

    A constant feature has neither a p-value nor a correlation (NaN or NULL); it is kept."""
    j = pvalues.join(corr, list(on))
    drop = (F.col("p") >= p_max) & ~F.isnan("p") & (F.abs("corr") < corr_min)
    return j.withColumn("keep", ~F.coalesce(drop, F.lit(False)))
