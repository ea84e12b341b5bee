"""A10 dataset manifest, A11 year splitting of date ranges."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def dataset_manifest(rows: DataFrame, expected: Sequence[str], *, dataset_col: str = "dataset",
                     ts_col: str = "ts", columns: Sequence[str] | None = None) -> DataFrame:
    """A10: per dataset rows, ok flag, first/last timestamp, column list.

    One aggregation pass over ``rows``; the (small, fixed) ``expected`` list is the
    left side so absent datasets show ``rows = 0, ok = false``.
    """
    spark: SparkSession = rows.sparkSession
    stats = rows.groupBy(dataset_col).agg(F.count(F.lit(1)).alias("rows"), F.min(ts_col).alias("first_ts"),
                                          F.max(ts_col).alias("last_ts"))
    names = spark.createDataFrame([(d,) for d in expected], [dataset_col])
    cols = ",".join(columns if columns is not None else [c for c in rows.columns if c != dataset_col])
    return (F.broadcast(names).join(stats, dataset_col, "left")
            .select(dataset_col, F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"),
                    (F.coalesce("rows", F.lit(0)) > 0).alias("ok"), "first_ts", "last_ts",
                    F.when(F.col("rows") > 0, F.lit(cols)).alias("columns")))


def split_at_years(start: Column, end: Column, *, half_open: bool = False, whole_days: bool = False) -> Column:
    """Array of ``struct(chunk_start, chunk_end)`` cutting [start, end] at calendar years.

    ``half_open`` cuts ``[start, end)`` into ``[Jan 1 y, Jan 1 y+1)`` pieces instead of
    closed pieces that reach the last microsecond of Dec 31. ``whole_days`` is for closed
    ranges of dates: a piece that ends on Dec 31 00:00 holds that day.
    """
    years = F.sequence(F.year(start), F.year(end))
    last = (0, 0, 0) if whole_days else (23, 59, Decimal("59.999999"))

    def piece(y):
        y0 = F.make_timestamp(y, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        if half_open:
            y1 = F.make_timestamp(y + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
        else:
            y1 = F.make_timestamp(y, F.lit(12), F.lit(31), *map(F.lit, last))
        return F.struct(F.greatest(start, y0).alias("chunk_start"), F.least(end, y1).alias("chunk_end"))

    return F.transform(years, piece)


def split_rolling_years(start: Column, end: Column) -> Column:
    """Array of ``struct(chunk_start, chunk_end)`` cutting [start, end) into half-open
    pieces of one year from ``start`` on; the last may be shorter.

    Each piece begins where the one before ends; from Feb 29 the next begins on Feb 28,
    as do all after it, so none is longer than a year. Without ``start < end`` there are none.
    """
    year = F.expr("interval 1 year")
    second = start + year
    starts = F.concat(F.array(start), F.sequence(second, F.greatest(second, end), year))
    return F.transform(F.filter(starts, lambda s: s < end),
                       lambda s: F.struct(s.alias("chunk_start"), F.least(s + year, end).alias("chunk_end")))
