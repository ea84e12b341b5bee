"""Query registry shared by ``__spark_entry__`` and ``bench.py``.

Each query: ``fn(spark, sf_dir) -> DataFrame`` plus, where the operator is
SQL-expressible, an equivalent DuckDB SQL string over the driver's views.
Floating outputs are rounded on both sides in two decimal stages (9, then 6
digits, half away from zero): sums are order-dependent in the last bits, and an
exact tie such as ``x.1271875`` must not flip with that noise.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_utc
from ..sources.readers import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round doubles, widen ints to bigint, so both engines agree on value and type."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(F.round(c.cast("double"), digits + 3), digits)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.DecimalType):
            c = F.round(F.round(c.cast("double"), digits + 3), digits)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def rounded_sql(inner: str, doubles: Sequence[str] = (), ints: Sequence[str] = (),
                dates: Sequence[str] = ()) -> str:
    """Wrap oracle SQL: round doubles, cast ints to BIGINT and dates to ISO text."""
    rep = [f"CAST(TRY_CAST(TRY_CAST({c} AS DECIMAL(38, {DIGITS + 3})) AS DECIMAL(38, {DIGITS})) AS DOUBLE) + 0.0 AS {c}"
           for c in doubles]
    rep += [f"CAST({c} AS BIGINT) AS {c}" for c in ints]
    rep += [f"strftime(CAST({c} AS DATE), '%Y-%m-%d') AS {c}" for c in dates]
    if not rep:
        return inner
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{inner}\n) AS q"


def query(name: str, sql: str | None = None, doubles: Sequence[str] = (), ints: Sequence[str] = (),
          dates: Sequence[str] = ()):
    """Register ``fn(spark, sf_dir)``; its result is passed through :func:`finish`."""

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            return finish(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = rounded_sql(sql, doubles, ints, dates)
        return run

    return deco


class Tables:
    """Lazy access to the driver tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str, *cols: str) -> DataFrame:
        return load_table(self.spark, self.sf_dir, name, cols or None)
