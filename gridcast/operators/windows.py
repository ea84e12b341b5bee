"""Ordered-window operators per series.

A plain ``Window.partitionBy(series)`` puts a whole series in one task, which
breaks when one series holds a large share of all rows. Every operator here
works on a *position* column instead and splits each series into buckets of
``bucket_rows`` consecutive positions:

* look-back windows (lags, rolling frames) copy the last ``lookback`` positions of
  each bucket into the next one (a "halo"), evaluate the window inside
  ``(series, bucket)`` and keep only the bucket's own rows — exact, no cap;
* unbounded running windows (forward fill, prefix sums) are evaluated inside the
  bucket and completed with a carry computed on a per-bucket summary table whose
  size is rows / bucket_rows.

Position modes:

* ``"rows"`` — dense 0-based row number in ``order`` (pandas ``shift`` parity;
  after a gap, lag 24 is 24 *rows* back). Built by :func:`position_index`
  (coarse time buckets + per-bucket offsets; no single-task window).
* ``"time"`` — ``floor(epoch seconds / step)``; lag 24 is 24 *steps* back and is
  NULL when that instant is absent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_ROWS = 1 << 16
_SPAN = 4096


def position_index(df: DataFrame, series: Sequence[str], order: Sequence[str], out: str = "pos",
                   coarse_seconds: int = 3600) -> DataFrame:
    """Dense 0-based row number per series, computed without a per-series task.

    Rows are cut into coarse time buckets (``floor(order[0] / coarse_seconds)``),
    numbered inside ``(series, bucket)`` and shifted by the number of rows of the
    same series in earlier buckets (a small ``(series, bucket) → count`` table).
    Every step is deterministic, so recomputing a lost partition gives the same
    numbers. ``order`` must be unique within a series (add an ingest ordinal as the
    last key when it is not); ``order[0]`` is a timestamp or a number.
    """
    first = F.col(order[0])
    key = F.unix_micros(first.cast("timestamp")) / 1_000_000 if dict(df.dtypes)[order[0]].startswith("timestamp") \
        else first
    d = df.withColumn("_cb", F.floor(key / F.lit(coarse_seconds)).cast("bigint"))
    counts = d.groupBy(*series, "_cb").agg(F.count(F.lit(1)).alias("_cnt"))
    # offsets in two levels, so that no window holds a whole series of buckets: spans of
    # _SPAN buckets first, then the buckets of one span
    counts = counts.withColumn("_sp", F.floor(F.col("_cb") / F.lit(_SPAN)))
    earlier_spans = Window.partitionBy(*series).orderBy("_sp").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*series, "_sp").orderBy("_cb").rowsBetween(Window.unboundedPreceding, -1)
    spans = counts.groupBy(*series, "_sp").agg(F.sum("_cnt").alias("_scnt"))
    spans = spans.select(*series, "_sp", F.coalesce(F.sum("_scnt").over(earlier_spans), F.lit(0)).alias("_soff"))
    offsets = (counts.withColumn("_off", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)))
               .join(spans, [*series, "_sp"])
               .select(*series, "_cb", (F.col("_off") + F.col("_soff")).alias("_off")))
    # explicit exchange on (series, bucket) so a hot series is numbered by many tasks
    local = Window.partitionBy(*series, "_cb").orderBy(*order)
    numbered = (d.repartition(*[F.col(c) for c in series], F.col("_cb"))
                .withColumn("_rn", F.row_number().over(local) - 1))
    return (numbered.join(offsets, [*series, "_cb"])
            .withColumn(out, (F.col("_off") + F.col("_rn")).cast("bigint"))
            .drop("_cb", "_rn", "_off"))


def time_position(ts: str | Column, step_seconds: int) -> Column:
    """Position of an instant on a regular grid of ``step_seconds``."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_seconds(t) / F.lit(step_seconds)).cast("bigint")


def with_position(df: DataFrame, series: Sequence[str], ts: str, mode: str = "rows",
                  step_seconds: int = 3600, tiebreak: Sequence[str] = (), out: str = "pos") -> DataFrame:
    if mode == "rows":
        return position_index(df, series, [ts, *tiebreak], out=out)
    if mode == "time":
        return df.withColumn(out, time_position(ts, step_seconds))
    raise ValueError(f"mode must be 'rows' or 'time', got {mode!r}")


def _with_halo(df: DataFrame, pos: str, lookback: int, bucket_rows: int) -> DataFrame:
    """Each row feeds its own bucket and every later bucket whose first ``lookback``
    positions can reach back to it. Adds ``_bkt`` (own bucket) and ``_tgt``."""
    b = F.lit(bucket_rows)
    own = F.floor(F.col(pos) / b)
    last = F.floor((F.col(pos) + F.lit(lookback)) / b)
    return (df.withColumn("_bkt", own)
              .withColumn("_tgt", F.explode(F.sequence(own, last))))


class Lookback:
    """Column recipes that only look ``k`` positions back (lags, rolling frames)."""

    def __init__(self):
        self.items: list[tuple[str, str, tuple]] = []

    def lag(self, name: str, col: str, k: int) -> "Lookback":
        self.items.append((name, "lag", (col, k)))
        return self

    def rolling_mean(self, name: str, col: str, lo: int, hi: int, min_periods: int) -> "Lookback":
        """Mean of ``col`` over positions [p-lo, p-hi] (lo ≥ hi ≥ 0) if ≥ min_periods values."""
        self.items.append((name, "mean", (col, lo, hi, min_periods)))
        return self

    def rolling_sum(self, name: str, col: str, lo: int, hi: int, min_periods: int = 1) -> "Lookback":
        self.items.append((name, "sum", (col, lo, hi, min_periods)))
        return self

    def lag_diff(self, name: str, col: str, k1: int, k2: int) -> "Lookback":
        """``lag(col, k1) - lag(col, k2)``."""
        self.items.append((name, "diff", (col, k1, k2)))
        return self

    def history(self, name: str, col: str, k: int) -> "Lookback":
        """Array of ``col`` at positions p-1, p-2, ... p-k, as far as they exist (no NULLs in ``col``,
        dense positions). One frame serves all k lags: lag l is ``get(name, l - 1)``."""
        self.items.append((name, "history", (col, k)))
        return self

    @property
    def lookback(self) -> int:
        m = 0
        for _, kind, a in self.items:
            m = max(m, a[1] if kind != "diff" else max(a[1], a[2]))
        return m


def lookback_features(df: DataFrame, series: Sequence[str], pos: str, spec: Lookback,
                      bucket_rows: int | None = None) -> DataFrame:
    """Evaluate all look-back columns of ``spec`` in one windowed pass (bucket + halo).

    All frames share one partitioning ``(series, bucket)`` and one ordering
    (position), so Spark plans a single Exchange and a single Window operator.
    Frames are *range* frames on the position: in ``rows`` mode that equals a rows
    frame, in ``time`` mode an absent instant simply has no value.
    """
    lb = max(spec.lookback, 1)
    br = bucket_rows or max(DEFAULT_BUCKET_ROWS, 4 * lb)
    # Explicit exchange on (series, bucket): an upstream hash(series) partitioning
    # would otherwise satisfy the window's clustering and keep a hot series in one task.
    h = _with_halo(df, pos, lb, br).repartition(*[F.col(c) for c in series], F.col("_tgt"))
    w = Window.partitionBy(*series, "_tgt").orderBy(F.col(pos))

    def at(col: str, k: int) -> Column:
        return F.first(F.col(col)).over(w.rangeBetween(-k, -k))

    new_cols = []
    for name, kind, a in spec.items:
        if kind == "lag":
            e = at(a[0], a[1])
        elif kind == "diff":
            e = at(a[0], a[1]) - at(a[0], a[2])
        elif kind == "history":
            e = F.reverse(F.collect_list(F.col(a[0])).over(w.rangeBetween(-a[1], -1)))
        else:
            col, lo, hi, mp = a
            fw = w.rangeBetween(-lo, -hi)
            agg = F.avg(col) if kind == "mean" else F.sum(col)
            e = F.when(F.count(F.col(col)).over(fw) >= mp, agg.over(fw))
        new_cols.append(e.alias(name))
    return (h.select("*", *new_cols).filter(F.col("_tgt") == F.col("_bkt")).drop("_tgt", "_bkt"))


def _running(df: DataFrame, series: Sequence[str], pos: str, cols: Sequence[str], bucket_rows: int,
             kind: str, reverse: bool = False) -> DataFrame:
    """Unbounded running window = in-bucket window + carry from earlier buckets."""
    bkt = F.floor(F.col(pos) / F.lit(bucket_rows))
    d = df.withColumn("_bkt", bkt).repartition(*[F.col(c) for c in series], F.col("_bkt"))
    o = F.col(pos).desc() if reverse else F.col(pos)
    w = Window.partitionBy(*series, "_bkt").orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    bo = F.col("_bkt").desc() if reverse else F.col("_bkt")
    wb = Window.partitionBy(*series).orderBy(bo).rowsBetween(Window.unboundedPreceding, -1)
    if kind == "fill":
        local = {c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols}
        pick = F.min_by if reverse else F.max_by
        summ = d.groupBy(*series, "_bkt").agg(
            *[pick(F.col(c), F.when(F.col(c).isNotNull(), F.col(pos))).alias(c) for c in cols])
        carry = summ.select(*series, "_bkt", *[F.last(F.col(c), ignorenulls=True).over(wb).alias(f"_carry_{c}")
                                               for c in cols])
        out = d.select("*", *[local[c].alias(f"_loc_{c}") for c in cols]).join(carry, [*series, "_bkt"], "left")
        return out.select(*[F.coalesce(f"_loc_{c}", f"_carry_{c}").alias(c) if c in cols else F.col(c)
                            for c in df.columns])
    if kind == "sum":
        summ = d.groupBy(*series, "_bkt").agg(*[F.sum(c).alias(c) for c in cols])
        carry = summ.select(*series, "_bkt", *[F.sum(c).over(wb).alias(f"_carry_{c}") for c in cols])
        out = d.select("*", *[F.sum(c).over(w).alias(f"_loc_{c}") for c in cols]).join(carry, [*series, "_bkt"], "left")

        def total(c):  # SQL running-sum semantics: NULL until the first value
            loc, car = F.col(f"_loc_{c}"), F.col(f"_carry_{c}")
            return F.when(loc.isNull() & car.isNull(), None).otherwise(
                F.coalesce(loc, F.lit(0)) + F.coalesce(car, F.lit(0)))

        return out.select(*df.columns, *[total(c).alias(f"cum_{c}") for c in cols])
    raise ValueError(kind)


def forward_fill(df: DataFrame, series: Sequence[str], pos: str, cols: Sequence[str],
                 bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Last non-NULL value at or before each position, per series."""
    return _running(df, series, pos, cols, bucket_rows, "fill")


def backward_fill(df: DataFrame, series: Sequence[str], pos: str, cols: Sequence[str],
                  bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """First non-NULL value at or after each position, per series."""
    return _running(df, series, pos, cols, bucket_rows, "fill", reverse=True)


def prefix_sums(df: DataFrame, series: Sequence[str], pos: str, cols: Sequence[str],
                bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Running sums ``cum_<col>`` (NULLs count as 0 once a value was seen)."""
    return _running(df, series, pos, cols, bucket_rows, "sum")


def lag_columns(df: DataFrame, series: Sequence[str], ts: str, value: str, lags: Sequence[int], *,
                mode: str = "rows", step_seconds: int = 3600, prefix: str = "lag",
                bucket_rows: int | None = None) -> DataFrame:
    """E1 convenience: ``lag<k>`` columns for each k."""
    d = with_position(df, series, ts, mode, step_seconds, out="_p")
    spec = Lookback()
    for k in lags:
        spec.lag(f"{prefix}{k}", value, k)
    return lookback_features(d, series, "_p", spec, bucket_rows).drop("_p")
