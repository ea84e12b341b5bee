"""I26, I27 feature tables and the I21 differencing gate.

A horizon spec lists the lags, lagged rolling frames, lag differences, the
weather treatment (forecast for the target hour, or actuals lagged 168 master
rows) and the holiday columns. The Spark builder and the SQL twin used by the
oracle are both generated from the same spec.

Leakage rule: every load column only looks at positions strictly before the
gate (lags ≥ 1), so changing the target after the gate never changes a row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import (HEAT_BASE_C, COOL_BASE_C, cyclical_calendar, holiday_classes, hour_harmonics)
from ..functions.numeric import clip
from ..functions.timefns import local_fields
from ..operators.windows import Lookback, lookback_features, with_position

WEATHER = ["temp_c", "wind10_ms", "wind100_ms", "ghi_wm2", "dni_wm2", "cloud_pct", "precip_mm", "rh_pct"]
_FC_NAMES = {"wind10_ms": "wind10_fc", "wind100_ms": "wind100_fc", "ghi_wm2": "ghi_fc", "dni_wm2": "dni_fc",
             "cloud_pct": "cloud_fc", "precip_mm": "precip_fc", "rh_pct": "rh_fc"}


@dataclass(frozen=True)
class Horizon:
    name: str
    lags: tuple[int, ...]
    rolls: dict = field(default_factory=dict)     # name -> (lo, hi, min_periods) positions back
    diffs: dict = field(default_factory=dict)     # name -> (k1, k2)
    weather_lag: int = 0                          # 0: forecast for the hour; >0: master rows back
    holidays: tuple[str, ...] = ("hol_easter_may", "hol_other", "pre_holiday", "post_holiday", "bridge_day")
    lags_on_master: bool = False                  # True: load lags over master rows (week-ahead)


# --- fixed values (must match the reference's feature sets) -------------------------
DAY_AHEAD = Horizon("1d", (24, 48, 168, 336, 720, 8760),
                    {"roll24_mean": (47, 24, 12), "roll168_mean": (191, 24, 84)},
                    {"diff_24_48": (24, 48), "diff_24_168": (24, 168)})
WEEK_AHEAD = Horizon("1w", (168, 336, 504, 720, 8760), {"roll168_mean": (335, 168, 84)},
                     {"diff_168_336": (168, 336)}, weather_lag=168,
                     holidays=("hol_easter_may", "pre_holiday", "post_holiday"), lags_on_master=True)
HOUR_AHEAD = Horizon("15min", (1, 2, 3, 24, 168), {"roll3_mean": (3, 1, 2), "roll24_mean": (24, 1, 12)},
                     {"diff1": (1, 2), "diff24": (1, 25)})
HORIZONS = {h.name: h for h in (DAY_AHEAD, WEEK_AHEAD, HOUR_AHEAD)}
SUPPLY_WEATHER = ["temperature_2m", "wind_speed_10m", "wind_speed_100m", "wind_direction_100m",
                  "shortwave_radiation", "direct_normal_irradiance", "cloud_cover", "precipitation",
                  "relative_humidity_2m"]
SUPPLY_FLAGS = ["is_weekend", "is_holiday", "prod_maint", "gen_maint", "gen_outages"]
# -------------------------------------------------------------------------------------


def weather_columns(h: Horizon) -> list[str]:
    if h.weather_lag:
        s = f"_lag{h.weather_lag}"
        return [f"temp{s}", f"temp_sq{s}", f"HDD{s}", f"CDD{s}"] + [f"{c}{s}" for c in WEATHER[1:]] + [
            "HDD_x_dayoff", "CDD_x_dayoff"]
    return ["temp_fc", "temp_sq_fc", "HDD_fc", "CDD_fc"] + [_FC_NAMES[c] for c in WEATHER[1:]] + [
        "HDD_x_dayoff", "CDD_x_dayoff"]


#: The prefixes that place a predictor in the load or calendar block; others are weather.
BLOCK_PREFIXES = {"LOAD": ("lag", "roll", "diff"), "CAL": ("sin", "cos", "is_", "hol", "pre_", "post_", "bridge")}


def feature_block(name: Column) -> Column:
    """H8: the block (LOAD, CAL or WX) of a predictor's name, by its prefix."""
    out = F.lit("WX")
    for block, prefixes in reversed(BLOCK_PREFIXES.items()):
        out = F.when(name.rlike("^(" + "|".join(prefixes) + ")"), F.lit(block)).otherwise(out)
    return out


def feature_columns(h: Horizon) -> list[str]:
    cal = [f"{f}{k}h{s}" for k in (1, 2, 3) for f in ("sin", "cos") for s in ("", "_workday")]
    cal += ["sindow", "cosdow", "sin_doy", "cos_doy", "is_day_off", *h.holidays]
    return [f"lag{k}" for k in h.lags] + list(h.rolls) + list(h.diffs) + weather_columns(h) + cal


def _load_spec(h: Horizon, col: str = "load") -> Lookback:
    spec = Lookback()
    for k in h.lags:
        spec.lag(f"lag{k}", col, k)
    for n, (lo, hi, mp) in h.rolls.items():
        spec.rolling_mean(n, col, lo, hi, mp)
    for n, (a, b) in h.diffs.items():
        spec.lag_diff(n, col, a, b)
    return spec


DAY_FLAGS = ["_off", "_hol", "pre_holiday", "post_holiday", "bridge_day"]


def day_flags(days_off: DataFrame) -> DataFrame:
    """``(date, is_holiday)`` of the days off -> one row per day off or next to one, with all 0/1 DAY_FLAGS.

    Each day off tells itself and its two neighbours, so the calendar is read once."""
    shifts = F.array(*[F.struct(F.lit(k).alias("k"), F.date_add("date", k).alias("d")) for k in (-1, 0, 1)])
    told = days_off.select(F.inline(shifts), F.col("is_holiday").alias("h"))

    def any_of(at: int, flag: Column | None = None) -> Column:
        return F.max(F.when(F.col("k") == at, F.lit(1) if flag is None else flag).otherwise(0))

    h = F.col("h")
    d = told.groupBy(F.col("d").alias("date")).agg(
        any_of(0).alias("_off"), any_of(0, h).alias("_hol"), any_of(-1, h).alias("pre_holiday"),
        any_of(1, h).alias("post_holiday"), (any_of(-1) * any_of(1)).alias("_between"))
    return d.select("date", *DAY_FLAGS[:4], (F.col("_between") * (1 - F.col("_off"))).alias("bridge_day"))


def build_features(h: Horizon, load: DataFrame, master: DataFrame, days_off: DataFrame, *,
                   series: tuple[str, ...] = ("series_id",), tz: str = "Europe/Sofia",
                   target: str = "load_actual_mw") -> DataFrame:
    """The horizon's feature table on the master's rows.

    ``load``: ``(series…, ts, load)`` full history (deduplicated); ``master``:
    ``(series…, ts, <WEATHER>)`` rows that the table is built on;
    ``days_off``: ``(date, is_holiday)`` calendar. Lags are positional.
    """
    s = list(series)
    spec = _load_spec(h)
    if h.lags_on_master:
        base = master.join(load, [*s, "ts"], "left")
        lagged = lookback_features(with_position(base, s, "ts", "rows", out="_p"), s, "_p", spec).drop("_p")
        base = lagged
    else:
        lagged = lookback_features(with_position(load, s, "ts", "rows", out="_p"), s, "_p", spec).drop("_p")
        base = master.join(lagged, [*s, "ts"], "left")
    if h.weather_lag:
        ws = Lookback()
        for c in WEATHER:
            ws.lag(f"_w_{c}", c, h.weather_lag)
        base = lookback_features(with_position(base, s, "ts", "rows", out="_q"), s, "_q", ws).drop("_q")
        wcol = {c: F.col(f"_w_{c}") for c in WEATHER}
    else:
        wcol = {c: F.col(c) for c in WEATHER}
    lf = local_fields("ts", tz)
    base = base.select("*", lf["hour"].alias("_h"), lf["dow"].alias("_dow"), lf["doy"].alias("_doy"),
                       lf["month"].alias("_mon"), lf["day"].alias("_day"), lf["local_date"].alias("_date"))
    base = base.join(F.broadcast(day_flags(days_off).withColumnRenamed("date", "_date")), "_date", "left").fillna(
        0, subset=DAY_FLAGS)  # a calendar: a few rows for each day off in the span
    off = F.col("_off").cast("double")
    t = wcol["temp_c"]
    hdd, cdd = clip(F.lit(HEAT_BASE_C) - t, lower=0.0), clip(t - F.lit(COOL_BASE_C), lower=0.0)
    out = [*[F.col(c) for c in s], "ts", F.col("load").alias(target)]
    out += [F.col(f"lag{k}") for k in h.lags] + [F.col(n) for n in h.rolls] + [F.col(n) for n in h.diffs]
    wn = weather_columns(h)
    out += [t.alias(wn[0]), F.pow(t, 2).alias(wn[1]), hdd.alias(wn[2]), cdd.alias(wn[3])]
    out += [wcol[c].alias(n) for c, n in zip(WEATHER[1:], wn[4:11])]
    out += [(hdd * off).alias("HDD_x_dayoff"), (cdd * off).alias("CDD_x_dayoff")]
    out += [c.alias(n) for n, c in hour_harmonics(F.col("_h"), 1 - off).items()]
    out += [c.alias(n) for n, c in cyclical_calendar(F.col("_dow"), F.col("_doy")).items()]
    out.append(off.alias("is_day_off"))
    hc = holiday_classes(F.col("_mon"), F.col("_day"), F.col("_hol").cast("double"))
    extra = {"hol_easter_may": hc["hol_easter_may"], "hol_other": hc["hol_other"],
             "pre_holiday": F.col("pre_holiday").cast("double"), "post_holiday": F.col("post_holiday").cast("double"),
             "bridge_day": F.col("bridge_day").cast("double")}
    out += [extra[n].alias(n) for n in h.holidays]
    return base.select(*out)


def supply_features(master: DataFrame, target: str = "supply") -> DataFrame:
    """Target + 9 weather + 5 flags, complete rows only (with a contract check)."""
    need = [target, *SUPPLY_WEATHER, *SUPPLY_FLAGS]
    missing = [c for c in need if c not in master.columns]
    if missing:
        raise ValueError(f"supply master lacks columns: {missing}")
    return master.select("ts", *need).dropna(subset=need)


def difference_gate(features: DataFrame, flags: DataFrame, series: tuple[str, ...] = ("series_id",),
                    target: str = "load_actual_mw", anchor: str = "lag24") -> DataFrame:
    """Where ``flags(series…, differenced)`` says that the level is not stationary, the target becomes
    ``target − anchor``. Adds ``differenced``; one plan serves series of both kinds."""
    j = features.join(flags, list(series))
    return j.withColumn(target, F.when(F.col("differenced"), F.col(target) - F.col(anchor)).otherwise(F.col(target)))


def undifference(pred: DataFrame, gated: DataFrame, series: tuple[str, ...] = ("series_id",), ts: str = "ts",
                 anchor: str = "lag24") -> DataFrame:
    """I21 inverse: forecast and actual of a differenced series are ``anchor`` + themselves."""
    back = gated.select(*series, ts, "differenced", F.when(F.col("differenced"), F.col(anchor)).otherwise(F.lit(0.0)).alias("_anchor"))
    return pred.join(back, [*series, ts]).select(
        *[F.col(c) + F.col("_anchor") if c in ("y", "yhat") else F.col(c) for c in pred.columns], "differenced").toDF(
        *pred.columns, "differenced")


# --- SQL twin (for the DuckDB oracle) ---------------------------------------------------

def features_sql(h: Horizon, load_cte: str, master_cte: str, holidays_sql: str, target: str = "load_actual_mw") -> str:
    """DuckDB SQL for :func:`build_features` given CTE bodies for ``load(series_id, ts, load)``,
    ``master(series_id, ts, <WEATHER>)`` and the holiday CTEs (``hol``/``off`` over ``dates``)."""
    w = "PARTITION BY series_id ORDER BY ts"

    def lag(c, k):
        return f"lag({c}, {k}) OVER ({w})"

    def frame(c, lo, hi, mp):
        fr = f"OVER ({w} ROWS BETWEEN {lo} PRECEDING AND {hi} PRECEDING)"
        return f"CASE WHEN count({c}) {fr} >= {mp} THEN avg({c}) {fr} END"

    loadcols = [f"{lag('load', k)} AS lag{k}" for k in h.lags]
    loadcols += [f"{frame('load', lo, hi, mp)} AS {n}" for n, (lo, hi, mp) in h.rolls.items()]
    loadcols += [f"{lag('load', a)} - {lag('load', b)} AS {n}" for n, (a, b) in h.diffs.items()]
    if h.lags_on_master:
        lagged = (f"lg AS (SELECT m.*, l.load, {', '.join(loadcols)} "
                  f"FROM ({master_cte}) m LEFT JOIN ({load_cte}) l USING (series_id, ts))")
        base = "b0 AS (SELECT * FROM lg)"
    else:
        lagged = f"lg AS (SELECT series_id, ts, load, {', '.join(loadcols)} FROM ({load_cte}))"
        base = f"b0 AS (SELECT m.*, lg.* EXCLUDE (series_id, ts) FROM ({master_cte}) m LEFT JOIN lg USING (series_id, ts))"
    if h.weather_lag:
        wsel = ", ".join(f"{lag(c, h.weather_lag)} AS w_{c}" for c in WEATHER)
        wx = f"b1 AS (SELECT *, {wsel} FROM b0)"
        wc = {c: f"w_{c}" for c in WEATHER}
    else:
        wx = "b1 AS (SELECT * FROM b0)"
        wc = {c: c for c in WEATHER}
    loc = "((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Sofia')"
    b2 = (f"b2 AS (SELECT b1.*, hour({loc}) AS _h, isodow({loc}) - 1 AS _dow, dayofyear({loc}) AS _doy, "
          f"month({loc}) AS _mon, day({loc}) AS _day, CAST({loc} AS DATE) AS _date FROM b1)")
    b3 = ("b3 AS (SELECT b2.*, CASE WHEN EXISTS (SELECT 1 FROM off WHERE off.d = _date) THEN 1.0 ELSE 0.0 END AS _off, "
          "CASE WHEN EXISTS (SELECT 1 FROM hol WHERE h = _date) THEN 1.0 ELSE 0.0 END AS _hol, "
          "CASE WHEN EXISTS (SELECT 1 FROM hol WHERE h = _date + 1) THEN 1.0 ELSE 0.0 END AS pre_holiday, "
          "CASE WHEN EXISTS (SELECT 1 FROM hol WHERE h = _date - 1) THEN 1.0 ELSE 0.0 END AS post_holiday, "
          "CASE WHEN NOT EXISTS (SELECT 1 FROM off WHERE off.d = _date) AND EXISTS (SELECT 1 FROM off WHERE off.d = _date - 1) "
          "AND EXISTS (SELECT 1 FROM off WHERE off.d = _date + 1) THEN 1.0 ELSE 0.0 END AS bridge_day FROM b2)")
    t = wc["temp_c"]
    hdd = f"CASE WHEN {t} IS NOT NULL THEN greatest({HEAT_BASE_C} - {t}, 0) END"
    cdd = f"CASE WHEN {t} IS NOT NULL THEN greatest({t} - {COOL_BASE_C}, 0) END"
    wn = weather_columns(h)
    sel = ["series_id", "ts", f"load AS {target}"] + [f"lag{k}" for k in h.lags] + list(h.rolls) + list(h.diffs)
    sel += [f"{t} AS {wn[0]}", f"power({t}, 2) AS {wn[1]}", f"{hdd} AS {wn[2]}", f"{cdd} AS {wn[3]}"]
    sel += [f"{wc[c]} AS {n}" for c, n in zip(WEATHER[1:], wn[4:11])]
    sel += [f"{hdd} * _off AS HDD_x_dayoff", f"{cdd} * _off AS CDD_x_dayoff"]
    for k in (1, 2, 3):
        for fn in ("sin", "cos"):
            e = f"{fn}(2 * pi() * {k} * _h / 24)"
            sel += [f"{e} AS {fn}{k}h", f"{e} * (1 - _off) AS {fn}{k}h_workday"]
    sel += ["sin(2 * pi() * _dow / 7) AS sindow", "cos(2 * pi() * _dow / 7) AS cosdow",
            "sin(2 * pi() * _doy / 365.25) AS sin_doy", "cos(2 * pi() * _doy / 365.25) AS cos_doy", "_off AS is_day_off"]
    em = "CASE WHEN _mon IN (4, 5) AND _day <= 10 THEN 1.0 ELSE 0.0 END * _hol"
    hx = {"hol_easter_may": em, "hol_other": f"least(greatest(_hol - {em}, 0), 1)", "pre_holiday": "pre_holiday",
          "post_holiday": "post_holiday", "bridge_day": "bridge_day"}
    sel += [f"{hx[n]} AS {n}" for n in h.holidays]
    return f"{holidays_sql}, {lagged}, {base}, {wx}, {b2}, {b3} SELECT {', '.join(sel)} FROM b3"
