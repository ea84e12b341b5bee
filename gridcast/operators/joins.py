"""Group C: equi, membership, lookup, neighbour-day, interval and as-of joins.

Interval overlap (C7/C8) is a sweep line, not a range join: each interval
contributes +v at the first grid point it covers and −v just after the last
one; deltas are summed per (category, grid point) with a map-side partial
aggregation and turned into coverage by a bucketed prefix sum over the grid.
Cost is O(intervals + grid points); no row is replicated per covered hour and
no nested-loop join is planned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .windows import DEFAULT_BUCKET_ROWS, prefix_sums

EXACT = "decimal(38,6)"  # running sums of MW are kept exact so covered-then-ended returns to 0


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose size is bounded *by construction* (a calendar: one row
    per day of the covered span; a fold table: one row per test block)."""
    return F.broadcast(df)


def inner_align(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Index intersection = inner equi join."""
    return a.join(b, list(keys), "inner")


def full_align(long: DataFrame, key: Sequence[str], pivot: str, value: str, names: Sequence[str]) -> DataFrame:
    """Full outer alignment of several series into one wide table.

    One shuffle (``groupBy(key).pivot``) instead of a chain of full outer joins.
    """
    return long.groupBy(*key).pivot(pivot, list(names)).agg(F.first(value))


def date_flag(df: DataFrame, date_col: Column, dates: DataFrame, out: str, dates_col: str = "date") -> DataFrame:
    """C4: 0/1 flag = the row's local date is in ``dates`` (calendar, bounded broadcast)."""
    d = dates.select(F.col(dates_col).alias("_fd")).distinct().withColumn(out, F.lit(1))
    j = df.withColumn("_fd", date_col).join(bounded_broadcast(d), "_fd", "left")
    return j.withColumn(out, F.coalesce(F.col(out), F.lit(0))).drop("_fd")


def lookup_default(df: DataFrame, dim: DataFrame, keys: Sequence[str], value: str, out: str | None = None,
                   default=0) -> DataFrame:
    """Dimension lookup, missing → ``default`` (``map().fillna(0)``)."""
    d = dim.select(*keys, F.col(value).alias("_lv"))
    j = df.join(d, list(keys), "left")
    return j.withColumn(out or value, F.coalesce("_lv", F.lit(default))).drop("_lv")


def neighbour_day_flags(dates: DataFrame, date_col: str, days_off: DataFrame) -> DataFrame:
    """Pre-holiday (d+1 is a holiday), post-holiday (d−1 is), bridge day
    (d not off, d−1 and d+1 off), with ``days_off(date, is_holiday)``."""
    off = days_off.select(F.col("date").alias("_d"), "is_holiday")
    hol = bounded_broadcast(off.filter(F.col("is_holiday") == 1).select("_d").distinct())
    offd = bounded_broadcast(off.select("_d").distinct())
    d = dates.select(date_col).distinct()

    def member(frame, name):
        return frame.withColumn(name, F.lit(1)).withColumnRenamed("_d", f"_{name}")

    j = (d.join(member(hol, "pre"), F.date_add(F.col(date_col), 1) == F.col("_pre"), "left")
          .join(member(hol, "post"), F.date_add(F.col(date_col), -1) == F.col("_post"), "left")
          .join(member(offd, "off0"), F.col(date_col) == F.col("_off0"), "left")
          .join(member(offd, "offm"), F.date_add(F.col(date_col), -1) == F.col("_offm"), "left")
          .join(member(offd, "offp"), F.date_add(F.col(date_col), 1) == F.col("_offp"), "left"))
    bridge = F.col("off0").isNull() & F.col("offm").isNotNull() & F.col("offp").isNotNull()
    return j.select(date_col, F.coalesce("pre", F.lit(0)).alias("pre_holiday"),
                    F.coalesce("post", F.lit(0)).alias("post_holiday"), bridge.cast("int").alias("bridge_day"))


def interval_coverage(intervals: DataFrame, grid_start: str | None = None, grid_end: str | None = None, *,
                      start: str = "start", end: str = "end", category: str = "category",
                      value: str | None = None, closed: bool = True, step_seconds: int = 3600,
                      categories: Sequence[str] | None = None,
                      bucket_rows: int = DEFAULT_BUCKET_ROWS) -> DataFrame:
    """Per (category, grid instant): number of covering intervals (``active``)
    and, with ``value``, the covered sum of ``value`` (``total``).

    ``closed=True`` counts ``start <= t <= end`` (C7); ``closed=False`` counts
    ``start <= t < end`` (C8). Intervals with a NULL bound or ``end`` before
    ``start`` cover nothing; ``categories`` keeps only known categories.

    Grid instants are multiples of ``step_seconds`` since the epoch. The grid runs
    from ``grid_start`` to ``grid_end`` when given, otherwise from the first to the
    last grid instant inside [min(start), max(end)] over *all* input rows. The
    interval table is scanned once: its rows become +v / −v deltas plus two bound
    markers, all reduced by one partial aggregation; every later step works on that
    small (category, position) table.
    """
    spark = intervals.sparkSession
    st, en = F.unix_seconds(F.col(start)), F.unix_seconds(F.col(end))
    first = F.ceil(st / F.lit(step_seconds)).cast("bigint")
    f_end = F.floor(en / F.lit(step_seconds)).cast("bigint")
    c_end = F.ceil(en / F.lit(step_seconds)).cast("bigint")
    last = f_end if closed else c_end - 1
    bounded = grid_start is not None and grid_end is not None
    if bounded:  # what began before the grid counts from its first instant on
        low = F.ceil(F.unix_seconds(F.to_timestamp(F.lit(grid_start))) / step_seconds).cast("bigint")
        high = F.floor(F.unix_seconds(F.to_timestamp(F.lit(grid_end))) / step_seconds).cast("bigint")
        first = F.greatest(first, low)
    v = F.col(value).cast(EXACT) if value else F.lit(0).cast(EXACT)
    known = F.col(category).isNotNull()
    if categories is not None:
        known = known & F.col(category).isin(list(categories))
    ok = F.col(start).isNotNull() & F.col(end).isNotNull() & (first <= last) & known
    zero = F.lit(0).cast(EXACT)
    def delta(cat, pos, dn, dv, use):
        return F.struct(cat.alias("category"), pos.alias("pos"), F.lit(dn).alias("d_n"), dv.alias("d_v"),
                        use.alias("_use"))

    cat = F.col(category).cast("string")
    none = F.lit(None).cast("string")
    rows = intervals.select(F.inline(F.array(
        delta(cat, first, 1, v, ok), delta(cat, last + 1, -1, -v, ok),
        delta(none, first, 0, zero, F.col(start).isNotNull()),
        delta(none, f_end, 0, zero, F.col(end).isNotNull()))))
    deltas = (rows.filter("_use").groupBy("category", "pos")
              .agg(F.sum("d_n").alias("d_n"), F.sum("d_v").alias("d_v")))
    # The delta table (categories × grid points) feeds the bounds, the grid join and
    # the carry; a reliable checkpoint keeps the interval scan to one pass.
    deltas = cut_lineage(deltas)
    if bounded:
        rng = spark.range(1).select(low.alias("_lo"), high.alias("_hi"))
    else:
        rng = deltas.filter(F.col("category").isNull()).agg(F.min("pos").alias("_lo"), F.max("pos").alias("_hi"))
    cats = (spark.createDataFrame([(c,) for c in categories], "category string") if categories is not None
            else deltas.filter(F.col("category").isNotNull()).select("category").distinct())
    # one-row range attached to the (few) categories: a scalar broadcast, not a pairing of data rows
    grid = cats.crossJoin(F.broadcast(rng)).select("category", F.explode(F.sequence("_lo", "_hi")).alias("pos"))
    g = grid.join(deltas.filter(F.col("category").isNotNull()), ["category", "pos"], "left")
    g = g.select("category", "pos", F.coalesce("d_n", F.lit(0)).alias("d_n"), F.coalesce("d_v", zero).alias("d_v"))
    cum = prefix_sums(g, ["category"], "pos", ["d_n", "d_v"], bucket_rows)
    cols = ["category", F.timestamp_seconds(F.col("pos") * step_seconds).alias("ts"),
            F.col("cum_d_n").alias("active")]
    if value:
        cols.append(F.col("cum_d_v").cast("double").alias("total"))
    return cum.select(*cols)


def asof_year(years: DataFrame, dim: DataFrame, year_col: str = "year", values: Sequence[str] = ("value",),
              keys: Sequence[str] = ()) -> DataFrame:
    """Yearly dimension on every requested year; gap years take the previous
    available year, leading years the next one.

    Requested years and dimension rows are unioned and ordered by year (dimension
    row first on equal years); a forward fill gives "previous or same", a backward
    fill the leading case. The table holds one row per (key, year), so even the
    un-keyed window is bounded by the calendar, not by data volume.
    """
    req = years.select(*keys, F.col(year_col).alias("_y")).distinct()
    for v in values:
        req = req.withColumn(v, F.lit(None).cast("double"))
    u = (req.withColumn("_req", F.lit(1))
         .unionByName(dim.select(*keys, F.col(year_col).alias("_y"), *[F.col(v).cast("double") for v in values])
                      .withColumn("_req", F.lit(0))))
    w = Window.partitionBy(*keys).orderBy("_y", "_req")
    fw = w.rowsBetween(Window.unboundedPreceding, 0)
    bw = w.rowsBetween(0, Window.unboundedFollowing)
    out = u.select(*keys, "_y", "_req", *[F.coalesce(F.last(v, True).over(fw), F.first(v, True).over(bw)).alias(v)
                                         for v in values])
    return out.filter(F.col("_req") == 1).select(*keys, F.col("_y").alias(year_col), *values)


def anti_names(names: DataFrame, used: DataFrame, col: str) -> DataFrame:
    """Names with no match (left anti join)."""
    return names.join(used.select(col).distinct(), col, "left_anti")
