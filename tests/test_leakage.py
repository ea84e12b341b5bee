"""No-leakage property: altering the target after a gate never changes feature rows up to the gate."""

import datetime as dt

from pyspark.sql import functions as F

from gridcast.plans.features import DAY_AHEAD, HOUR_AHEAD, build_features
from gridcast.plans.features import WEATHER


def _inputs(spark, bump_after=None):
    t0 = dt.datetime(2024, 1, 1)
    load, master = [], []
    for i in range(400):
        ts = t0 + dt.timedelta(hours=i)
        v = float((i * 37) % 50) + 100
        if bump_after is not None and i > bump_after:
            v += 1000.0
        load.append(("s", ts, v))
        master.append(("s", ts, *[float(i % 7 + j) for j in range(len(WEATHER))]))
    ld = spark.createDataFrame(load, "series_id string, ts timestamp, load double")
    ms = spark.createDataFrame(master, "series_id string, ts timestamp, " + ", ".join(f"{c} double" for c in WEATHER))
    off = spark.createDataFrame([(dt.date(2024, 1, 1), 1)], "date date, is_holiday int")
    return ld, ms, off


def test_features_do_not_look_past_the_gate(spark):
    gate = 300
    for h in (DAY_AHEAD, HOUR_AHEAD):
        a = build_features(h, *_inputs(spark))
        b = build_features(h, *_inputs(spark, bump_after=gate))
        cut = F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(hours=gate + 1))
        cols = [c for c in a.columns if c not in ("load_actual_mw",)]
        ra = {r.ts: r for r in a.filter(F.col("ts") <= cut).select(*cols).collect()}
        rb = {r.ts: r for r in b.filter(F.col("ts") <= cut).select(*cols).collect()}
        assert ra == rb, h.name
