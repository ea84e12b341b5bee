"""Gram-table regressions and walk-forward evaluation.

* The data is read once per pass. Rows are tagged with an elementary *segment*
  (cut at every fold, calibration and CV boundary, in row-position space), and a
  single built-in ``groupBy(series, segment).agg(sum(x_i·x_j) …)`` builds the
  sufficient statistics with map-side partial aggregation (I2).
* A fold's training window, a CV split or a calibration window is a contiguous
  range of segments, so its Gram is a sum of a few small arrays; no row is
  rescanned per fold or per alpha.
* Solvers (ridge with a GCV-chosen α, lasso and elastic net by exact paths with
  ``TimeSeriesSplit``-style CV) run per (series, fold, model) on executors via
  ``applyInPandas`` over k×k statistics only.
* Predictions join a coefficient table to the test rows and take the dot
  product with built-in array functions (I8).

This is the way for windows that no task can hold; bounded windows are fitted row by row
in ``walkforward.py``, with exact leave-one-out for ridge. Here ridge α is chosen by
generalised cross-validation on the Gram. Sums are taken of values less their series
mean, so that squares do not cancel.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.windows import position_index
from ..session import cut_lineage
from .folds import rows_in_folds, test_membership

RIDGE_ALPHAS = tuple(float(a) for a in np.logspace(-2, 4, 13))
EN_L1_RATIOS = (0.1, 0.5, 0.7, 0.9, 0.95, 0.99)
N_ALPHAS, ALPHA_EPS = 100, 1e-3
CD_MAX_SWEEPS, CD_GAP = 8000, 1e-3


# --- I2: Gram table -----------------------------------------------------------------

def gram_table(df: DataFrame, keys: Sequence[str], features: Sequence[str | Column], y: str) -> DataFrame:
    """Sufficient statistics per ``keys`` in one aggregation:
    ``n, sy, syy, sx[k], sxy[k], sxx[k(k+1)/2]`` (upper triangle, row-major).
    A feature is a column name or an expression."""
    k = len(features)
    x = [(F.col(f) if isinstance(f, str) else f).cast("double") for f in features]
    yy = F.col(y).cast("double")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(yy).alias("sy"), F.sum(yy * yy).alias("syy")]
    aggs += [F.sum(x[i]).alias(f"_sx{i}") for i in range(k)]
    aggs += [F.sum(x[i] * yy).alias(f"_sxy{i}") for i in range(k)]
    aggs += [F.sum(x[i] * x[j]).alias(f"_sxx{i}_{j}") for i, j in pairs]
    g = df.groupBy(*keys).agg(*aggs)
    return g.select(*keys, "n", "sy", "syy", F.array(*[f"_sx{i}" for i in range(k)]).alias("sx"),
                    F.array(*[f"_sxy{i}" for i in range(k)]).alias("sxy"),
                    F.array(*[f"_sxx{i}_{j}" for i, j in pairs]).alias("sxx"))


_HELD_GRAMS = 1 << 22  # numbers that a task holds before it hands its partial Grams on


def gram_of_arrays(df: DataFrame, keys: Sequence[str], x: str, y: str, k: int) -> DataFrame:
    """:func:`gram_table` for one array column ``x`` of ``k`` numbers a row.

    Tasks sum numpy partial Grams of ``[1, y, x]`` per key; their entries are added up by
    position. The plan has the same size for any ``k``. Keys are few (groups, segments);
    a task hands on what it holds when they are many.
    """
    keys = list(keys)
    size = k + 2
    upper = np.triu_indices(size)
    schema = T.StructType([df.schema[c] for c in keys] + [T.StructField("_g", T.ArrayType(T.DoubleType()))])

    def run(batches):
        held: dict[tuple, np.ndarray] = {}

        def handed_on():
            types = [pa.list_(pa.float64())]
            names = list(held)
            columns = [pa.array([n[i] for n in names], t, from_pandas=True) for i, t in enumerate(key_types)]
            sums = pa.array([held[n][upper] for n in names], types[0])
            return pa.RecordBatch.from_arrays([*columns, sums], [*keys, "_g"])

        key_types = []
        for b in batches:
            key_types = key_types or [b.column(i).type for i in range(len(keys))]
            values = b.column(len(keys) + 1)
            rows = np.empty((b.num_rows, size))
            rows[:, 0], rows[:, 1] = 1.0, b.column(len(keys)).to_numpy(zero_copy_only=False)
            rows[:, 2:] = values.flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, k)
            own = pd.DataFrame({i: b.column(i).to_pandas() for i in range(len(keys))})
            for key, at in own.groupby(list(own.columns), dropna=False, sort=False).indices.items():
                part = rows[at]
                key = tuple(own.iloc[at[0]]) if keys else key
                held[key] = held.get(key, 0.0) + part.T @ part
            if len(held) * size * size > _HELD_GRAMS:
                yield handed_on()
                held.clear()
        if held:
            yield handed_on()

    partial = df.select(*keys, F.col(y).cast("double").alias("_y"), F.col(x).alias("_x")).mapInArrow(run, schema)
    summed = (partial.select(*keys, F.posexplode("_g").alias("_i", "_v")).groupBy(*keys, "_i").agg(F.sum("_v").alias("_v"))
              .groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_i", "_v")))["_v"].alias("_g")))
    g = F.col("_g")  # rows of the upper triangle: [n, sy, sx…], [syy, sxy…], [sxx…]
    return summed.select(*keys, g[0].cast("long").alias("n"), g[1].alias("sy"), g[size].alias("syy"),
                         F.slice(g, 3, k).alias("sx"), F.slice(g, size + 2, k).alias("sxy"),
                         F.slice(g, 2 * size, k * (k + 1) // 2).alias("sxx"))


class Gram:
    """Sufficient statistics of one window (sum of segment rows)."""

    def __init__(self, n, sy, syy, sx, sxy, sxx):
        self.n, self.sy, self.syy = float(n), float(sy), float(syy)
        self.sx, self.sxy, self.sxx = np.asarray(sx, float), np.asarray(sxy, float), np.asarray(sxx, float)

    @staticmethod
    def from_rows(rows: pd.DataFrame, k: int) -> "Gram":
        if len(rows) == 0:
            return Gram(0, 0, 0, np.zeros(k), np.zeros(k), np.zeros((k, k)))
        iu = np.triu_indices(k)
        sxx = np.zeros((k, k))
        tri = np.stack(rows["sxx"].to_numpy()).sum(0)
        sxx[iu] = tri
        sxx = sxx + sxx.T - np.diag(np.diag(sxx))
        return Gram(rows["n"].sum(), rows["sy"].sum(), rows["syy"].sum(), np.stack(rows["sx"].to_numpy()).sum(0),
                    np.stack(rows["sxy"].to_numpy()).sum(0), sxx)

    def scaler(self):
        """StandardScaler (ddof 0) fitted on this window; zero variance → scale 1."""
        mu = self.sx / self.n
        var = np.diag(self.sxx) / self.n - mu * mu
        sd = np.sqrt(np.clip(var, 0, None))
        sd[sd <= 1e-12 * np.maximum(1.0, np.abs(mu))] = 1.0
        return mu, sd

    def centred(self, mu, sd):
        """(ZcᵀZc, Zcᵀyc, ycᵀyc, z̄, ȳ) of this window in the units ``(x − mu) / sd``,
        centred on the window's own means (fit_intercept)."""
        xbar = self.sx / self.n
        ybar = self.sy / self.n
        cxx = (self.sxx - self.n * np.outer(xbar, xbar)) / np.outer(sd, sd)
        cxy = (self.sxy - self.n * xbar * ybar) / sd
        cyy = self.syy - self.n * ybar * ybar
        return cxx, cxy, cyy, (xbar - mu) / sd, ybar

    def sse(self, b0, beta_z, mu, sd):
        """Σ (y − b0 − zᵀβ)² over this window, from sums only."""
        # in raw units: y − (b0 − βᵀ mu/sd) − xᵀ(β/sd)
        w = beta_z / sd
        c = b0 - float(w @ mu)
        return (self.syy - 2 * c * self.sy - 2 * float(w @ self.sxy) + self.n * c * c
                + 2 * c * float(w @ self.sx) + float(w @ self.sxx @ w))


def ridge_gcv(cxx, cxy, cyy, n, alphas=RIDGE_ALPHAS):
    """Ridge on centred standardised statistics; α by generalised CV."""
    k = len(cxy)
    evals, evecs = np.linalg.eigh(cxx)
    proj = evecs.T @ cxy
    best = None
    for a in alphas:
        beta = evecs @ (proj / (evals + a))
        rss = cyy - 2 * beta @ cxy + beta @ cxx @ beta
        df = float(np.sum(evals / (evals + a))) + 1.0  # + intercept
        gcv = n * max(rss, 0.0) / max(n - df, 1e-9) ** 2
        if best is None or gcv < best[0]:
            best = (gcv, a, beta)
    return best[2], best[1]


def duality_gap(cxx, cxy, cyy, n, alpha, l1_ratio, beta):
    """Relative duality gap of elastic-net coefficients, per problem (leading batch axis)."""
    l1, l2 = n * alpha * l1_ratio, n * alpha * (1 - l1_ratio)
    fitted = np.einsum("bij,bj->bi", cxx, beta)
    rss = cyy - 2 * np.sum(beta * cxy, axis=1) + np.sum(beta * fitted, axis=1)
    steepest = np.max(np.abs(cxy - fitted - l2[:, None] * beta), axis=1)
    scale = np.minimum(1.0, l1 / np.maximum(steepest, 1e-300))  # makes the residual dual feasible
    gap = (0.5 * rss * (1 + scale ** 2) + l1 * np.abs(beta).sum(axis=1) - scale * (cyy - np.sum(beta * cxy, axis=1))
           + 0.5 * l2 * (1 + scale ** 2) * np.sum(beta ** 2, axis=1))
    return gap / np.maximum(cyy, 1e-300)


def _cd_batch(cxx, cxy, n, alphas, l1_ratio, tol=1e-4, max_iter=CD_MAX_SWEEPS, cyy=None):
    """Elastic-net coordinate descent for a batch of problems, warm-started along
    each problem's alpha path (all arrays have a leading batch axis B).

    Objective per problem: (1/2n)‖y − Zβ‖² + α·ρ‖β‖₁ + α(1−ρ)/2‖β‖², on centred
    Grams ``cxx[B,k,k]``, ``cxy[B,k]``. ``alphas[B,A]``. Returns ``betas[B,A,k]``. Stops at a
    relative coefficient change of ``tol``; given ``cyy[B]``, at a relative duality gap of CD_GAP.
    """
    cxx, cxy = np.asarray(cxx, float), np.asarray(cxy, float)
    bsz, k = cxy.shape
    n = np.asarray(n, float).reshape(bsz)
    rho_l1 = np.asarray(l1_ratio, float).reshape(bsz)
    alphas = np.asarray(alphas, float).reshape(bsz, -1)
    cyy = None if cyy is None else np.asarray(cyy, float).reshape(bsz)
    diag = np.einsum("bjj->bj", cxx)
    live = diag > 0
    beta = np.zeros((bsz, k))
    out = np.zeros((bsz, alphas.shape[1], k))
    for a in range(alphas.shape[1]):
        l1 = n * alphas[:, a] * rho_l1
        l2 = n * alphas[:, a] * (1 - rho_l1)
        for _ in range(max_iter):
            delta = np.zeros(bsz)
            for j in range(k):
                r = cxy[:, j] - np.einsum("bk,bk->b", cxx[:, j, :], beta) + diag[:, j] * beta[:, j]
                new = np.where(live[:, j], np.sign(r) * np.maximum(np.abs(r) - l1, 0.0) / (diag[:, j] + l2 + ~live[:, j]),
                               0.0)
                delta = np.maximum(delta, np.abs(new - beta[:, j]))
                beta[:, j] = new
            if cyy is None:
                if np.all(delta <= tol * np.maximum(1.0, np.max(np.abs(beta), axis=1))):
                    break
            elif np.all(duality_gap(cxx, cxy, cyy, n, alphas[:, a], rho_l1, beta) < CD_GAP):
                break
        out[:, a, :] = beta
    return out


def lasso_path_lars(cxx, cxy, n, alphas):
    """Exact lasso path on a centred Gram by LARS with the lasso drop rule.

    The solution is piecewise linear in λ = n·α; breakpoints are found in closed
    form (at most a few times k steps) and the path is interpolated at ``alphas``.
    """
    cxx, cxy = np.asarray(cxx, float), np.asarray(cxy, float)
    k = len(cxy)
    beta = np.zeros(k)
    corr = cxy.copy()
    lam = float(np.max(np.abs(corr))) if k else 0.0
    active = [int(np.argmax(np.abs(corr)))] if k and lam > 0 else []
    knots = [(lam, beta.copy())]
    for _ in range(CD_MAX_SWEEPS):
        if not active or lam <= 0:
            break
        a = np.array(active)
        sgn = np.sign(corr[a])
        d_a = np.linalg.lstsq(cxx[np.ix_(a, a)], sgn, rcond=None)[0]
        d = np.zeros(k)
        d[a] = d_a
        adir = cxx @ d
        gamma, join, drop = lam, None, None
        for j in range(k):
            if j in active:
                continue
            for num, den in ((lam - corr[j], 1 - adir[j]), (lam + corr[j], 1 + adir[j])):
                if den > 1e-12:
                    g = num / den
                    if 1e-12 < g < gamma:
                        gamma, join, drop = g, j, None
        for idx, j in enumerate(active):
            if d[j] != 0:
                g = -beta[j] / d[j]
                if 1e-12 < g < gamma:
                    gamma, join, drop = g, None, j
        beta = beta + gamma * d
        corr = corr - gamma * adir
        lam = lam - gamma
        if drop is not None:
            beta[drop] = 0.0
            active.remove(drop)
        elif join is not None:
            active.append(join)
        knots.append((max(lam, 0.0), beta.copy()))
        if lam <= 1e-12:
            break
    lams = np.array([kn[0] for kn in knots])
    betas = np.array([kn[1] for kn in knots])
    out = []
    for al in np.asarray(alphas, float):
        t = n * al
        if t >= lams[0]:
            out.append(np.zeros(k))
            continue
        i = int(np.searchsorted(-lams, -t))  # first knot with lam <= t
        if i >= len(lams):
            out.append(betas[-1].copy())
            continue
        l0, l1_ = lams[i - 1], lams[i]
        w = 0.0 if l0 == l1_ else (l0 - t) / (l0 - l1_)
        out.append(betas[i - 1] + w * (betas[i] - betas[i - 1]))
    return np.array(out)


def feature_sign(cxx: np.ndarray, cxy: np.ndarray, l1: float, l2: float, beta: np.ndarray) -> np.ndarray:
    """The exact minimiser of ``½βᵀ(C + l2)β − cᵀβ + l1‖β‖₁``, from a start ``beta``: signs are guessed, solved
    for, and corrected along the line to the solution; every step lowers the objective."""
    h = cxx + l2 * np.eye(len(cxy))
    beta = beta.copy()
    floor = 1e-10 * max(float(np.max(np.abs(cxy))), 1e-300)

    def cost(b):
        return 0.5 * b @ h @ b - cxy @ b + l1 * np.abs(b).sum()

    for _ in range(50 * len(cxy) + 100):
        gradient = h @ beta - cxy
        sign = np.sign(beta)
        off = np.where(sign == 0, np.abs(gradient), 0.0)
        j = int(np.argmax(off))
        settled = np.max(np.abs(np.where(sign != 0, gradient + l1 * sign, 0.0))) <= max(floor, 1e-9 * l1)
        if off[j] <= l1 + max(floor, 1e-9 * l1):
            if settled:
                return beta
        elif settled or not sign.any():
            sign[j] = -np.sign(gradient[j])
        active = np.flatnonzero(sign)
        new = np.zeros_like(beta)
        new[active] = np.linalg.lstsq(h[np.ix_(active, active)], cxy[active] - l1 * sign[active], rcond=None)[0] \
            if l2 <= 0 else np.linalg.solve(h[np.ix_(active, active)], cxy[active] - l1 * sign[active])
        step = new - beta
        with np.errstate(divide="ignore", invalid="ignore"):
            crossing = np.where((beta != 0) & (step != 0), -beta / step, np.inf)
        points = [1.0, *sorted(set(crossing[(crossing > 0) & (crossing < 1)]))]
        tried = []
        for t in points:
            b = beta + t * step
            b[(crossing == t) & (t < 1)] = 0.0
            tried.append((cost(b), b))
        low, b = min(tried, key=lambda c: c[0])
        if low >= cost(beta) and np.array_equal(np.sign(b), np.sign(beta)):
            return b if low < cost(beta) else beta
        beta = b
    return beta


def elastic_net_path(cxx, cxy, n: float, alphas: Sequence[float], l1_ratio: float) -> np.ndarray:
    """Coefficients at each of ``alphas`` (falling), each from the one before."""
    beta, out = np.zeros(len(cxy)), []
    for a in alphas:
        beta = feature_sign(cxx, cxy, n * a * l1_ratio, n * a * (1 - l1_ratio), beta)
        out.append(beta)
    return np.array(out)


def _alpha_grid(cxy, n, l1_ratio):
    amax = np.max(np.abs(cxy)) / (n * l1_ratio) if n > 0 else 1.0
    amax = max(amax, 1e-12)
    return np.logspace(np.log10(amax * ALPHA_EPS), np.log10(amax), N_ALPHAS)[::-1]


def cv_elastic_net(train: Gram, splits: list[tuple[Gram, Gram]], mu, sd, l1_ratios):
    """LassoCV / ElasticNetCV on Grams: per l1 ratio an alpha grid from the full
    training window, mean test MSE over the CV splits (all splits × ratios solved
    as one batch), the best (ratio, alpha), then a refit on the full window."""
    cxx, cxy, cyy, _, _ = train.centred(mu, sd)
    grids = {rho: _alpha_grid(cxy, train.n, rho) for rho in l1_ratios}
    probs = [(rho, si) for rho in l1_ratios for si in range(len(splits))]
    stats = [splits[si][0].centred(mu, sd) for _, si in probs]
    if tuple(l1_ratios) == (1.0,):  # pure lasso: exact piecewise-linear path
        betas = np.stack([lasso_path_lars(st[0], st[1], splits[si][0].n, grids[1.0])
                          for st, (_, si) in zip(stats, probs)])
    else:
        betas = np.stack([elastic_net_path(st[0], st[1], splits[si][0].n, grids[rho], rho)
                          for st, (rho, si) in zip(stats, probs)])
    best = None
    for rho in l1_ratios:
        mse = np.zeros(N_ALPHAS)
        for b, (r2, si) in enumerate(probs):
            if r2 != rho:
                continue
            _, _, _, zbar, ybar = stats[b]
            te = splits[si][1]
            for i in range(N_ALPHAS):
                bz = betas[b, i]
                mse[i] += te.sse(ybar - float(zbar @ bz), bz, mu, sd) / max(te.n, 1.0)
        mse /= max(len(splits), 1)
        i = int(np.argmin(mse))
        if best is None or mse[i] < best[0]:
            best = (mse[i], grids[rho][i], rho)
    _, a, rho = best
    if rho == 1.0:
        beta = lasso_path_lars(cxx, cxy, train.n, [a])[0]
    else:
        beta = elastic_net_path(cxx, cxy, train.n, [v for v in grids[rho] if v >= a], rho)[-1]
    gap = duality_gap(cxx[None], cxy[None], np.array([cyy]), np.array([train.n]), np.array([a]), np.array([rho]), beta[None])
    return beta, a, rho, float(gap[0])


COEF_SCHEMA = T.StructType([
    T.StructField("fold_id", T.IntegerType()), T.StructField("model", T.StringType()),
    T.StructField("intercept", T.DoubleType()), T.StructField("beta", T.ArrayType(T.DoubleType())),
    T.StructField("alpha", T.DoubleType()), T.StructField("l1_ratio", T.DoubleType()),
    T.StructField("gap", T.DoubleType()), T.StructField("n_train", T.LongType())])


def _solver(k: int, series_cols: Sequence[str]):
    """Fits one model of one fold from the Gram rows of its training segments -> one coefficient row."""

    def solve(segments: pd.DataFrame) -> pd.DataFrame:
        columns = [*series_cols, *COEF_SCHEMA.names]
        head = segments.iloc[0]
        roles = {r["role"]: (r["seg_lo"], r["seg_hi"]) for r in head["roles"]}

        def window(role):
            lo, hi = roles[role]
            return Gram.from_rows(segments[(segments["seg"] >= lo) & (segments["seg"] < hi)], k)

        tr = window("train")
        if tr.n < 2:
            return pd.DataFrame(columns=columns)
        mu, sd = tr.scaler()
        cxx, cxy, cyy, zbar, ybar = tr.centred(mu, sd)
        if head["model"] == "ridge":
            (bz, a), rho, gap = ridge_gcv(cxx, cxy, cyy, tr.n), 0.0, 0.0
        else:
            splits = [(window(r), window(r.replace("train", "test"))) for r in sorted(roles) if r.startswith("cvtrain")]
            bz, a, rho, gap = cv_elastic_net(tr, splits, mu, sd, (1.0,) if head["model"] == "lasso" else EN_L1_RATIOS)
        b0z = ybar - float(zbar @ bz)  # intercept in z units
        w = bz / sd
        return pd.DataFrame([{**{c: head[c] for c in series_cols}, "fold_id": int(head["fold_id"]), "model": head["model"],
                              "intercept": float(b0z - w @ mu), "beta": [float(v) for v in w], "alpha": float(a),
                              "l1_ratio": float(rho), "gap": gap, "n_train": int(tr.n)}], columns=columns)

    return solve


def fold_plan(comp: DataFrame, folds: DataFrame, series: Sequence[str], ts: str, min_train: int,
              cv_splits: int) -> DataFrame:
    """``(series…, fold_id, role, lo, hi)``: the row positions ``[lo, hi)`` of each role of each fold.

    Rows are counted per stretch between two of the folds' instants (a fold has four, so
    stretches are bounded by the calendar); the rows before an instant are a sum of
    stretches. Roles: train, cal, test and ``cvtrain<i>``/``cvtest<i>``, which cut the
    training window into ``cv_splits`` + 1 stretches of equal size (the first takes the rest).
    """
    marks = ["train_start", "cal_start", "test_start", "test_end"]
    cuts = folds.select(F.explode(F.array(*marks)).alias("at")).agg(F.array_sort(F.collect_set("at")).alias("cuts"))
    upto = F.size(F.filter("cuts", lambda c: c <= F.col(ts)))
    counts = comp.crossJoin(F.broadcast(cuts)).groupBy(*series, upto.alias("s")).agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy(*series).agg(F.collect_list(F.struct("s", "n")).alias("st"))

    def before(mark: str) -> Column:
        earlier = F.filter("st", lambda x: x["s"] < F.array_position("cuts", F.col(mark)))
        return F.aggregate(earlier, F.lit(0).cast("bigint"), lambda t, x: t + x["n"])

    at = (per.crossJoin(F.broadcast(folds.crossJoin(cuts)))  # one row per series and fold
          .select(*series, "fold_id", *[before(m).alias(c) for m, c in zip(marks, "abcd")])
          .filter((F.col("b") - F.col("a") >= min_train) & (F.col("d") > F.col("c")))
          .withColumn("size", F.floor((F.col("b") - F.col("a")) / F.lit(cv_splits + 1))))

    def role(name: str, lo: Column, hi: Column) -> Column:
        return F.struct(F.lit(name).alias("role"), lo.alias("lo"), hi.alias("hi"))

    a, b, size = F.col("a"), F.col("b"), F.col("size")
    roles = [role("train", a, b), role("cal", b, F.col("c")), role("test", F.col("c"), F.col("d"))]
    for i in range(cv_splits):
        roles += [role(f"cvtrain{i}", a, b - size * (cv_splits - i)),
                  role(f"cvtest{i}", b - size * (cv_splits - i), b - size * (cv_splits - i - 1))]
    return at.select(*series, "fold_id", F.inline(F.array(*roles))).filter("hi > lo")


def predict(df: DataFrame, coefs: DataFrame, features: Sequence[str], on: Sequence[str], out: str = "yhat") -> DataFrame:
    """I8: ``intercept + Σ βᵢ xᵢ`` with built-in array functions (stays in codegen)."""
    x = F.array(*[F.col(f).cast("double") for f in features])
    dot = F.aggregate(F.zip_with("beta", x, lambda b, v: b * v), F.lit(0.0), lambda acc, v: acc + v)
    return df.join(coefs, list(on)).withColumn(out, F.col("intercept") + dot).drop("beta", "intercept")


def walk_forward_linear(feat: DataFrame, folds: DataFrame, *, series: Sequence[str], ts: str, y: str,
                        features: Sequence[str], models: Sequence[str] = ("ridge", "lasso", "elasticnet"),
                        min_train: int = 4000, cv_splits: int = 4, with_train_mae: bool = True):
    """Walk-forward refit per fold (I8) for the linear models.

    Returns ``(predictions, coefficients, train_mae)``:
    predictions ``(series…, fold_id, model, ts, y, yhat)`` on the test blocks,
    coefficients per (series, fold, model), and the mean training MAE over folds
    per (series, model) (``None`` unless ``with_train_mae``).
    Folds with fewer than ``min_train`` complete training rows or an empty test
    block are skipped.
    """
    series, features, k = list(series), list(features), len(features)
    comp = feat.select(*series, ts, y, *features).dropna()
    plan = cut_lineage(fold_plan(comp, folds, series, ts, min_train, cv_splits))  # series × folds × roles rows
    bounds = plan.groupBy(*series).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array("lo", "hi"))))).alias("bounds"))

    def segment(p: str) -> Column:
        return F.size(F.filter("bounds", lambda x: x <= F.col(p)))

    plan = plan.join(bounds, series).select(*series, "fold_id", F.struct(
        "role", segment("lo").alias("seg_lo"), segment("hi").alias("seg_hi")).alias("r"))
    train = plan.groupBy(*series, "fold_id").agg(F.collect_list("r").alias("roles")).withColumn(
        "_train", F.filter("roles", lambda r: r["role"] == "train")[0])
    means = comp.groupBy(*series).agg(F.avg(y).alias("_my"), F.array(*[F.avg(f) for f in features]).alias("_mx"))
    rows = (position_index(comp, series, [ts]).join(bounds, series).join(means, series)
            .select(*series, segment("pos").alias("seg"), (F.col(y) - F.col("_my")).alias("_y"),
                    *[(F.col(f) - F.col("_mx")[i]).alias(f) for i, f in enumerate(features)]))
    gram = gram_table(rows, [*series, "seg"], features, "_y")
    # each (series, fold, model) gets its own copy of the few Gram rows of its training window
    own = (gram.join(train, series).filter("seg >= _train.seg_lo and seg < _train.seg_hi").drop("_train")
           .withColumn("model", F.explode(F.array(*[F.lit(m) for m in models]))))
    group = [*series, "fold_id", "model"]
    out_schema = T.StructType([feat.schema[c] for c in series] + COEF_SCHEMA.fields)
    coefs = own.groupBy(*group).applyInPandas(_solver(k, series), out_schema)
    back = F.aggregate(F.zip_with("beta", "_mx", lambda b, m: b * m), F.lit(0.0), lambda t, v: t + v)
    coefs = coefs.join(means, series).select(
        *series, *[(F.col("intercept") + F.col("_my") - back).alias(c) if c == "intercept" else F.col(c)
                   for c in COEF_SCHEMA.names])
    coefs = cut_lineage(coefs)  # one row per (series, fold, model): predictions and errors reuse the fit
    weights = coefs.select(*group, "intercept", "beta")
    preds = predict(test_membership(comp, folds, ts), weights, features, [*series, "fold_id"]).select(
        *series, "fold_id", "model", ts, F.col(y).alias("y"), "yhat")
    train_mae = None
    if with_train_mae:
        inside = rows_in_folds(comp, folds, ts, "train_start", "cal_start")
        tp = predict(inside, weights, features, [*series, "fold_id"])
        per_fold = tp.groupBy(*series, "model", "fold_id").agg(F.avg(F.abs(F.col("yhat") - F.col(y))).alias("m"))
        train_mae = per_fold.groupBy(*series, "model").agg(F.avg("m").alias("train_mae"))
    return preds, coefs, train_mae


def fixed_linear(train: DataFrame, features: Sequence[str], y: str, specs: Sequence[tuple[str, float, float]]) -> DataFrame:
    """One fit per ``(model, alpha, l1_ratio)`` at given penalties, from one Gram of ``train``:
    ``(model, intercept, beta)``. l1_ratio 0 is ridge (‖y − Xβ‖² + α‖β‖²), others as in
    :func:`_cd_batch`. Columns are used as they are (standardise before)."""
    k = len(features)
    gram = gram_table(train.withColumn("_all", F.lit(1)), ["_all"], features, y)
    specs = list(specs)

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        g = Gram.from_rows(rows, k)
        cxx, cxy, cyy, xbar, ybar = g.centred(np.zeros(k), np.ones(k))
        out = []
        for model, alpha, rho in specs:
            if rho == 0:
                beta = np.linalg.solve(cxx + alpha * np.eye(k), cxy)
            elif rho == 1:
                beta = lasso_path_lars(cxx, cxy, g.n, [alpha])[0]
            else:
                beta = _cd_batch([cxx], [cxy], [g.n], [[alpha]], [rho], tol=1e-9)[0, 0]
            out.append({"model": model, "intercept": float(ybar - xbar @ beta), "beta": [float(v) for v in beta]})
        return pd.DataFrame(out, columns=["model", "intercept", "beta"])

    return gram.groupBy("_all").applyInPandas(solve, "model string, intercept double, beta array<double>")


def learning_curve_windows(spark, end_ts: str, windows_days: Sequence[int], valid_days: int = 45):
    """One 'fold' per training length: train on the last d days before the
    validation block (the last ``valid_days``), validate on that block."""
    rows = [(i + 1, d) for i, d in enumerate(windows_days)]
    w = spark.createDataFrame(rows, "fold_id int, days int")
    end = F.to_timestamp(F.lit(end_ts))
    vstart = end - F.make_dt_interval(F.lit(valid_days))
    return w.select("fold_id", "days", (vstart - F.make_dt_interval(F.col("days"))).alias("train_start"),
                    vstart.alias("cal_start"), vstart.alias("test_start"),
                    (end + F.make_dt_interval(F.lit(0), F.lit(1))).alias("test_end"))
