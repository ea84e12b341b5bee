"""gridcast: Spark-native operators for hourly energy time series.

Every public operator takes and returns a DataFrame. Series are long tables
``(series cols…, ts TIMESTAMP, value DOUBLE)`` keyed by instants under a UTC
session; wall-clock fields are derived columns, never keys.
"""

__version__ = "0.1.0"
