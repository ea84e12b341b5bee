"""Bucket+halo windows equal plain per-series windows (incl. bucket edges, NULLs, min_periods)."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridcast.operators.windows import (Lookback, backward_fill, forward_fill, lookback_features, position_index,
                                        prefix_sums, time_position)


def _frame(spark, n=300):
    t0 = dt.datetime(2025, 3, 28)
    rows = []
    for s in ("a", "b"):
        for i in range(n):
            if i % 17 == 5:  # gaps: positional and time lags differ
                continue
            v = None if i % 11 == 3 else float((i * 7919) % 101)
            rows.append((s, t0 + dt.timedelta(hours=i), v))
    return spark.createDataFrame(rows, "s string, ts timestamp, v double")


def test_position_index_matches_row_number(spark):
    df = _frame(spark)
    p = position_index(df, ["s"], ["ts"], coarse_seconds=7 * 3600)
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("s").orderBy("ts")) - 1)
    j = p.join(ref, ["s", "ts"])
    assert j.filter("pos != rn").count() == 0 and j.count() == df.count()


def test_lags_and_rolling_bucketed_equal_plain(spark):
    df = position_index(_frame(spark), ["s"], ["ts"])
    spec = Lookback().lag("l1", "v", 1).lag("l24", "v", 24).rolling_mean("r", "v", 47, 24, 12).lag_diff("d", "v", 1, 3)
    got = lookback_features(df, ["s"], "pos", spec, bucket_rows=16)  # many buckets, halo spans several
    w = Window.partitionBy("s").orderBy("ts")
    fr = w.rowsBetween(-47, -24)
    ref = df.select("s", "ts", F.lag("v", 1).over(w).alias("l1"), F.lag("v", 24).over(w).alias("l24"),
                    F.when(F.count("v").over(fr) >= 12, F.avg("v").over(fr)).alias("r"),
                    (F.lag("v", 1).over(w) - F.lag("v", 3).over(w)).alias("d"))
    a = {(r.s, r.ts): (r.l1, r.l24, r.r, r.d) for r in got.collect()}
    b = {(r.s, r.ts): (r.l1, r.l24, r.r, r.d) for r in ref.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for x, y in zip(a[k], b[k]):
            assert (x is None and y is None) or abs(x - y) < 1e-9


def test_min_periods_edge(spark):
    rows = [("a", i, float(i) if i != 1 else None) for i in range(4)]
    df = spark.createDataFrame(rows, "s string, pos long, v double")
    got = lookback_features(df, ["s"], "pos", Lookback().rolling_mean("r", "v", 3, 1, 2)).orderBy("pos").collect()
    # pos 2 sees [v0, v1=NULL] → 1 value < 2 → NULL; pos 3 sees v0, NULL, v2 → 2 values → mean 1.0
    assert got[2].r is None and got[3].r == 1.0


def test_time_mode_lag_is_null_after_gap(spark):
    df = _frame(spark).withColumn("p", time_position("ts", 3600))
    got = lookback_features(df, ["s"], "p", Lookback().lag("l1", "v", 1))
    # the row right after a missing hour has no value exactly one hour back
    t0 = dt.datetime(2025, 3, 28)
    r = got.filter((F.col("s") == "a") & (F.col("ts") == F.lit(t0 + dt.timedelta(hours=6)))).first()
    assert r.l1 is None


def test_fill_and_prefix_sums_bucketed(spark):
    df = position_index(_frame(spark), ["s"], ["ts"])
    ff = forward_fill(df, ["s"], "pos", ["v"], bucket_rows=8).withColumnRenamed("v", "ff")
    bf = backward_fill(df, ["s"], "pos", ["v"], bucket_rows=8).withColumnRenamed("v", "bf")
    cs = prefix_sums(df, ["s"], "pos", ["v"], bucket_rows=8)
    w = Window.partitionBy("s").orderBy("pos")
    ref = df.select("s", "pos", F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rf"),
                    F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("rb"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("rc"))
    j = ff.join(bf.select("s", "pos", "bf"), ["s", "pos"]).join(cs.select("s", "pos", "cum_v"), ["s", "pos"]).join(
        ref, ["s", "pos"])
    for r in j.collect():
        assert r.ff == r.rf and r.bf == r.rb
        assert (r.cum_v is None and r.rc is None) or abs(r.cum_v - r.rc) < 1e-6
