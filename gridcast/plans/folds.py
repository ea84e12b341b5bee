"""I1 fold tables, C10 row × fold membership, I9 chronological split.

A fold table has one row per test block, so it is bounded by the calendar
(span / block length), never by data volume; it is broadcast where joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _interval(seconds: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))


def fold_table(spark: SparkSession, test0: str, end: DataFrame | str, *, test_seconds: int, train_seconds: int,
               cal_seconds: int = 0, step_seconds: int = 3600) -> DataFrame:
    """``(fold_id, train_start, cal_start, test_start, test_end)``.

    Test blocks start at ``test0`` and step by ``test_seconds`` while
    ``test_start <= end``; the last block ends at ``end + step`` at most. The
    training window is ``[train_start, cal_start)`` with ``cal_start = test_start −
    cal_seconds`` and ``train_start = cal_start − train_seconds``; the calibration
    window (if any) is ``[cal_start, test_start)``. ``end`` is a timestamp string
    or a one-row DataFrame with an ``end`` column (e.g. ``max(ts)`` of the data).
    """
    if isinstance(end, str):
        end = spark.range(1).select(F.to_timestamp(F.lit(end)).alias("end"))
    starts = end.select("end", F.explode(F.sequence(F.to_timestamp(F.lit(test0)), F.col("end"),
                                                    _interval(test_seconds))).alias("test_start"))
    f = starts.select(
        "test_start",
        F.least(F.col("test_start") + _interval(test_seconds), F.col("end") + _interval(step_seconds)).alias("test_end"),
        (F.col("test_start") - _interval(cal_seconds)).alias("cal_start"))
    f = f.withColumn("train_start", F.col("cal_start") - _interval(train_seconds))
    # fold ids over a calendar-bounded table (one row per block)
    return f.select(F.row_number().over(Window.orderBy("test_start")).alias("fold_id"), "train_start", "cal_start",
                    "test_start", "test_end")


def fold_counts(df: DataFrame, folds: DataFrame, ts: str = "ts", series: Sequence[str] = (),
                step_seconds: int = 3600) -> DataFrame:
    """Rows per fold and role (train / cal / test), per series.

    Rows are first counted per (series, step), a partial aggregation whose size is
    bounded by the calendar, and only that table is spread over the folds.
    """
    per = df.groupBy(*series, F.col(ts).alias("_t")).agg(F.count(F.lit(1)).alias("_n"))
    j = rows_in_folds(per, folds, "_t", "train_start", "test_end").join(F.broadcast(folds), "fold_id")
    role = (F.when(F.col("_t") >= F.col("test_start"), "test")
            .when(F.col("_t") >= F.col("cal_start"), "cal").otherwise("train"))
    c = j.groupBy(*series, "fold_id", role.alias("role")).agg(F.sum("_n").alias("rows"))
    return c


def fold_row_counts(df: DataFrame, folds: DataFrame, ts: str = "ts", series: Sequence[str] = ()) -> DataFrame:
    """Wide counts ``(series…, fold_id, n_train, n_cal, n_test)`` with zeros."""
    c = fold_counts(df, folds, ts, series)
    w = c.groupBy(*series, "fold_id").pivot("role", ["train", "cal", "test"]).agg(F.first("rows"))
    return w.select(*series, "fold_id", *[F.coalesce(F.col(r), F.lit(0)).cast("bigint").alias(f"n_{r}")
                                          for r in ("train", "cal", "test")])


def valid_folds(counts: DataFrame, min_train: int, min_test: int = 1, min_cal: int = 0) -> DataFrame:
    """Skip folds with too few training (or calibration) rows or an empty test block."""
    return counts.filter((F.col("n_train") >= min_train) & (F.col("n_test") >= min_test)
                         & (F.col("n_cal") >= min_cal))


def rows_in_folds(df: DataFrame, folds: DataFrame, ts: str, start: str, stop: str) -> DataFrame:
    """Each row once for every fold with ``start <= ts < stop``, plus ``fold_id``.

    The fold table travels as one array (a row per test block, bounded by the calendar),
    so a row meets only its own folds and no inequality join is planned.
    """
    spans = folds.agg(F.collect_list(F.struct("fold_id", F.col(start).alias("a"), F.col(stop).alias("b"))).alias("_spans"))
    own = F.filter("_spans", lambda f: (F.col(ts) >= f["a"]) & (F.col(ts) < f["b"]))
    return (df.crossJoin(F.broadcast(spans)).select(*df.columns, F.explode(own).alias("_f"))
            .select(*df.columns, F.col("_f.fold_id").alias("fold_id")))


def test_membership(df: DataFrame, folds: DataFrame, ts: str = "ts") -> DataFrame:
    """C10 (test role): each row with the fold whose test block holds it (blocks do not overlap)."""
    return rows_in_folds(df, folds, ts, "test_start", "test_end")


def chronological_split(df: DataFrame, ts: str, at: str) -> tuple[DataFrame, DataFrame]:
    """Rows before ``at`` (train) and from ``at`` on (test)."""
    cut = F.to_timestamp(F.lit(at))
    return df.filter(F.col(ts) < cut), df.filter(F.col(ts) >= cut)
