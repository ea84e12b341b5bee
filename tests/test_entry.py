"""Driver contract and a few registered queries end to end."""

import __spark_entry__ as E


def test_contract_keys(spark):
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 100


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and {"series_id", "model", "mae"} <= set(df.columns)


def test_feature_table_has_reference_widths(spark):
    from gridcast.plans.features import HORIZONS, feature_columns

    assert {k: len(feature_columns(h)) for k, h in HORIZONS.items()} == {"1d": 45, "1w": 40, "15min": 44}
