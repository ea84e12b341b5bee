"""Group B: dedupe, grids, alignment, resampling, fills, trims and profiles; G1-G3 unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .windows import DEFAULT_BUCKET_ROWS, backward_fill, forward_fill, time_position


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] | str, keep: str = "first") -> DataFrame:
    """One row per key — first (or last) by an explicit ordinal.

    ``order`` is the ingest ordinal (file order) captured at the read; never
    ``dropDuplicates``, whose survivor is arbitrary. The window is partitioned by
    the full key (series *and* timestamp), so a hot series still spreads.
    """
    order = [order] if isinstance(order, str) else list(order)
    o = [F.col(c).desc() if keep == "last" else F.col(c).asc() for c in order]
    w = Window.partitionBy(*keys).orderBy(*o)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def grid_bounds(df: DataFrame, series: Sequence[str], ts: str, step: str = "1 hour", rule: str = "floor_ceil",
                cut: str | None = None) -> DataFrame:
    """B6 bounds per series: ``(series…, grid_start, grid_end)``.

    ``rule``: ``"minmax"`` (first/last instant as is), ``"floor_ceil"`` (truncate the
    start to the step and round the end up). ``cut`` raises the start to
    ``max(cut, start)``.
    """
    unit = step.split()[-1].rstrip("s")
    agg = df.groupBy(*series).agg(F.min(ts).alias("grid_start"), F.max(ts).alias("grid_end"))
    if rule == "floor_ceil":
        fl = F.date_trunc(unit, "grid_end")
        agg = agg.select(*series, F.date_trunc(unit, "grid_start").alias("grid_start"),
                         F.when(fl == F.col("grid_end"), fl)
                          .otherwise(fl + F.expr(f"INTERVAL {step}")).alias("grid_end"))
    if cut is not None:
        agg = agg.withColumn("grid_start", F.greatest("grid_start", F.to_timestamp(F.lit(cut))))
    return agg


def explode_grid(bounds: DataFrame, series: Sequence[str], step: str = "1 hour", ts: str = "ts") -> DataFrame:
    """One row per grid instant between each series' bounds (inclusive).

    The grid's size is (time span / step) per series — bounded by the calendar,
    not by the number of raw rows.
    """
    return bounds.select(*series, F.explode(F.sequence("grid_start", "grid_end", F.expr(f"INTERVAL {step}"))).alias(ts))


def hourly_grid(df: DataFrame, series: Sequence[str], ts: str = "ts", step: str = "1 hour",
                rule: str = "minmax", cut: str | None = None) -> DataFrame:
    return explode_grid(grid_bounds(df, series, ts, step, rule, cut), series, step, ts)


def align_to_grid(grid: DataFrame, df: DataFrame, keys: Sequence[str], values: Sequence[str] | None = None) -> DataFrame:
    """Left join of the grid and the series; missing → NULL, off-grid rows dropped."""
    cols = list(keys) + (list(values) if values is not None else [c for c in df.columns if c not in keys])
    return grid.join(df.select(*cols), list(keys), "left")


def resample(df: DataFrame, series: Sequence[str], ts: str, values: Sequence[str], unit: str = "hour",
             how: str = "mean", out_ts: str = "ts") -> DataFrame:
    """Down-sample to ``unit`` buckets.

    ``how="first_on_mark"`` takes the value stamped exactly on the bucket start (the
    reference's "take the hour"); ``mean``/``sum``/``count``/``last`` aggregate with a
    map-side partial aggregation, so a hot series is combined before the shuffle.
    """
    b = F.date_trunc(unit, F.col(ts))
    if how == "first_on_mark":
        return df.filter(b == F.col(ts)).select(*series, F.col(ts).alias(out_ts), *values)
    fn = {"mean": F.avg, "sum": F.sum, "count": F.count, "max": F.max, "min": F.min}
    if how == "last":
        aggs = [F.max_by(v, ts).alias(v) for v in values]
    else:
        aggs = [fn[how](v).alias(v) for v in values]
    return df.groupBy(*series, b.alias(out_ts)).agg(*aggs)


def fill_on_grid(df: DataFrame, series: Sequence[str], ts: str, cols: Sequence[str], method: str = "ffill",
                 step_seconds: int = 3600, bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """B9 (``ffill``) / B10 (``ffill_bfill``) on a regular grid, per series."""
    d = df.withColumn("_p", time_position(ts, step_seconds))
    if method in ("ffill", "ffill_bfill"):
        d = forward_fill(d, series, "_p", cols, bucket_rows)
    if method in ("bfill", "ffill_bfill"):
        d = backward_fill(d, series, "_p", cols, bucket_rows)
    return d.drop("_p")


def trim(df: DataFrame, ts: str, cut: str | None = None, require: Sequence[str] = ()) -> DataFrame:
    """Keep ``ts >= cut`` and rows whose required columns are present."""
    cond = F.lit(True)
    if cut is not None:
        cond = cond & (F.col(ts) >= F.to_timestamp(F.lit(cut)))
    for c in require:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def drop_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with any NULL in ``subset`` (count the dropped ones with :func:`count_incomplete`)."""
    return df.dropna(subset=list(subset))


def count_incomplete(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    cond = F.lit(False)
    for c in subset:
        cond = cond | F.col(c).isNull()
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(cond).alias("dropped"))


def drop_empty_columns_fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns that are entirely NULL, fill the rest with 0.

    One aggregation pass decides which columns survive; only that one summary row
    (k counts) reaches the driver.
    """
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first().asDict()
    keep = [c for c in cols if counts[c] > 0]
    others = [c for c in df.columns if c not in cols]
    return df.select(*others, *keep).fillna(0.0, subset=keep)


def null_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count per column (long form ``column, nulls``) plus total rows."""
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot("_rows", list(cols), "column", "nulls").withColumnRenamed("_rows", "rows")


def completeness(df: DataFrame, cols: Sequence[str], ts: str) -> DataFrame:
    """Rows, complete rows, first/last instant."""
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(complete).alias("complete_rows"),
                  F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def schema_violations(df: DataFrame, declared: T.StructType) -> DataFrame:
    """``(column, problem, declared, found, rows)`` for each violation of a declared schema.

    Problems: ``missing`` column, other ``type``, ``null`` in a column declared without (with the number
    of rows), ``undeclared`` column. For the others ``rows`` is the size of the table. One pass; no rows
    out where the contract holds.
    """
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in declared.fields}
    said = [(c, "missing", t, None) for c, t in wanted.items() if c not in found]
    said += [(c, "type", t, found[c]) for c, t in wanted.items() if c in found and found[c] != t]
    said += [(c, "undeclared", None, t) for c, t in found.items() if c not in wanted]
    strict = [f.name for f in declared.fields if not f.nullable and f.name in found]
    said += [(c, "null", wanted[c], found[c]) for c in strict]
    counts = df.agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(F.col(c).isNull()).alias(f"_n_{c}") for c in strict])
    rows = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(("column", "problem", "declared", "found"), r)],
                     F.col(f"_n_{r[0]}" if r[1] == "null" else "_all").alias("rows")) for r in said]
    if not rows:
        return df.sparkSession.createDataFrame([], "column string, problem string, declared string, found string, rows long")
    return counts.select(F.inline(F.array(*rows))).where("problem <> 'null' OR rows > 0")


def check_schema(df: DataFrame, declared: Sequence[str] | T.StructType) -> DataFrame:
    """Raise when a declared column is missing or, given a ``StructType``, has another type. No data is read."""
    names = declared.names if isinstance(declared, T.StructType) else declared
    wrong = [c for c in names if c not in df.columns]
    if isinstance(declared, T.StructType):
        wrong += [f"{f.name}: {df.schema[f.name].dataType.simpleString()} instead of {f.dataType.simpleString()}"
                  for f in declared.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    if wrong:
        raise ValueError(f"missing columns or other types: {wrong}")
    return df


def rebuild_comparison(new: DataFrame, old: DataFrame, key: str | Sequence[str], target: str) -> DataFrame:
    """Rows new/old/common, same columns?, max |new - old| of the target."""
    same = sorted(new.columns) == sorted(old.columns)
    keys = [key] if isinstance(key, str) else list(key)
    n = new.select(*keys, F.col(target).alias("_n"), F.lit(1).alias("_in_n"))
    o = old.select(*keys, F.col(target).alias("_o"), F.lit(1).alias("_in_o"))
    j = n.join(o, keys, "full")
    return j.agg(F.count("_in_n").alias("rows_new"), F.count("_in_o").alias("rows_old"),
                 F.count_if(F.col("_in_n").isNotNull() & F.col("_in_o").isNotNull()).alias("rows_common"),
                 F.max(F.abs(F.col("_n") - F.col("_o"))).alias("max_abs_diff"),
                 F.lit(same).alias("same_columns"))


def dst_audit(df: DataFrame, ts: str = "ts", tz: str = "Europe/Sofia", series: Sequence[str] = (),
              expected: int = 24) -> DataFrame:
    """Local dates whose hourly row count is not ``expected`` (23/25 on DST days)."""
    d = F.to_date(F.from_utc_timestamp(F.col(ts), tz)).alias("local_date")
    return (df.groupBy(*series, d).agg(F.count(F.lit(1)).alias("hours"))
            .filter(F.col("hours") != expected))


# --- G1-G3: unions ---------------------------------------------------------------

def union_chunks(chunks: Sequence[DataFrame], keys: Sequence[str] | None = None,
                 order: Sequence[str] | None = None) -> DataFrame:
    """G1: union of chunks by name; with ``keys`` the union is de-duplicated keep-first."""
    out = chunks[0]
    for c in chunks[1:]:
        out = out.unionByName(c, allowMissingColumns=True)
    if keys:
        out = dedupe(out, keys, order or keys)
    return out


def tagged_union(parts: Sequence[DataFrame], tag: str = "seq", start: int = 1) -> DataFrame:
    """Union with a 1-based tag per input, no de-duplication."""
    out = None
    for i, p in enumerate(parts, start):
        t = p.withColumn(tag, F.lit(i))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def priority_stitch(primary: DataFrame, secondary: DataFrame, keys: Sequence[str], ts: str,
                    primary_until: Column | str | None = None, source_col: str = "source",
                    names: tuple[str, str] = ("archive", "forecast")) -> DataFrame:
    """Primary rows up to ``primary_until`` plus the secondary tail; primary wins overlaps."""
    p = primary
    if primary_until is not None:
        lim = F.to_timestamp(F.lit(primary_until)) if isinstance(primary_until, str) else primary_until
        p = p.filter(F.col(ts) <= lim)
    u = (p.withColumn(source_col, F.lit(names[0])).withColumn("_prio", F.lit(0))
         .unionByName(secondary.withColumn(source_col, F.lit(names[1])).withColumn("_prio", F.lit(1)),
                      allowMissingColumns=True))
    return dedupe(u, keys, ["_prio"]).drop("_prio")
