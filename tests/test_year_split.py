"""Calendar years of timestamps and rolling years."""

import datetime as dt

from pyspark.sql import functions as F

import gridcast.sources as sources


def pieces(spark, start, end, split, **options):
    df = spark.createDataFrame([(start, end)], "start timestamp_ntz, end timestamp_ntz").select(
        *(F.col(c).cast("timestamp").alias(c) for c in ("start", "end")))
    rows = df.select(F.inline(split(F.col("start"), F.col("end"), **options)))
    text = rows.select(*(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in rows.columns)).collect()
    return [tuple(dt.datetime.fromisoformat(x) for x in r) for r in text]


def test_closed_pieces_of_timestamps_hold_all_of_dec_31(spark):
    start, end, us = dt.datetime(2023, 12, 31, 6), dt.datetime(2025, 12, 31, 20, 30), dt.timedelta(microseconds=1)
    got = pieces(spark, start, end, sources.split_at_years)
    assert got == [(start, dt.datetime(2024, 1, 1) - us), (dt.datetime(2024, 1, 1), dt.datetime(2025, 1, 1) - us),
                   (dt.datetime(2025, 1, 1), end)]
    days = pieces(spark, dt.datetime(2023, 12, 30), dt.datetime(2024, 1, 2), sources.split_at_years, whole_days=True)
    assert [b for _, b in days] == [dt.datetime(2023, 12, 31), dt.datetime(2024, 1, 2)]


def test_rolling_years_meet_and_are_at_most_a_year(spark):
    def after(t):
        try:
            return t.replace(year=t.year + 1)
        except ValueError:
            return t.replace(year=t.year + 1, day=28)

    for start, end in ((dt.datetime(2021, 3, 5, 7), dt.datetime(2024, 6, 1)), (dt.datetime(2024, 2, 29, 1), dt.datetime(2029, 3, 1)),
                       (dt.datetime(2022, 1, 1), dt.datetime(2024, 1, 1)), (dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 2))):
        want, at = [], start
        while at < end:
            want.append((at, min(after(at), end)))
            at = after(at)
        assert pieces(spark, start, end, sources.split_rolling_years) == want
    for start, end in ((dt.datetime(2022, 1, 1),) * 2, (dt.datetime(2023, 1, 1), dt.datetime(2022, 1, 1)), (None, dt.datetime(2022, 1, 1)),
                       (dt.datetime(2022, 1, 1), None)):
        assert pieces(spark, start, end, sources.split_rolling_years) == []
