"""Snapshots, partitioned tables, schema contracts, the differencing gate, and scans that are not repeated."""

import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as E
from gridcast.operators.timegrid import check_schema, schema_violations
from gridcast.plans.features import difference_gate, undifference
from gridcast.plans.linear import gram_of_arrays, gram_table
from gridcast.plans.q_sources import written_by_year
from gridcast.session import scratch_folder
from gridcast.sources.readers import read_newest, write_table

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_a_filter_on_the_partition_column_reads_its_folders_only(spark):
    one = written_by_year(spark, SF).where("year = 1997")
    assert re.search(r"PartitionFilters: \[.*\(year#\d+ = 1997\)\]", plan_of(one))
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert one.count() == orders.where(F.year("o_orderdate") == 1997).count() > 0
    assert all("year=1997" in r[0] for r in one.select("_metadata.file_path").distinct().collect())


def test_newest_snapshot_of_the_exact_name(spark):
    root = scratch_folder(spark, "test-snapshots")
    for name, n in (("load/a", 3), ("load/b", 5), ("load_forecast/c", 7)):
        write_table(spark.range(n), f"{root}/{name}")
    assert read_newest(spark, root, "load").count() == 5
    with pytest.raises(FileNotFoundError):
        read_newest(spark, root, "loa")


def test_schema_contract(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 2.5, "y")], "a long, b double, c string")
    kept = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])
    assert schema_violations(df, kept).count() == 0
    broken = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.DoubleType(), False), T.StructField("d", T.StringType())])
    got = {tuple(r) for r in schema_violations(df, broken).collect()}
    assert got == {("a", "type", "int", "bigint", 2), ("b", "null", "double", "double", 1), ("d", "missing", "string", None, 2),
                   ("c", "undeclared", None, "string", 2)}
    assert check_schema(df, kept) is df and check_schema(df, ["a"]) is df
    with pytest.raises(ValueError, match="a: bigint instead of int"):
        check_schema(df, T.StructType([T.StructField("a", T.IntegerType())]))


def test_gate_differences_one_series_and_goes_back(spark):
    t = pd.date_range("2024-01-01", periods=40, freq="h")
    data = pd.concat([pd.DataFrame({"series_id": s, "ts": t, "load_actual_mw": np.arange(40.0) * k, "lag24": np.arange(40.0) * k - 5})
                      for s, k in (("flat", 1), ("walk", 3))])
    flags = spark.createDataFrame([("flat", False), ("walk", True)], "series_id string, differenced boolean")
    gated = difference_gate(spark.createDataFrame(data), flags)
    assert {r[0] for r in gated.where("series_id = 'walk'").select("load_actual_mw").collect()} == {5.0}
    preds = gated.select("series_id", "ts", F.col("load_actual_mw").alias("y"), (F.col("load_actual_mw") + 1).alias("yhat"))
    back = undifference(preds, gated).toPandas().merge(data, on=["series_id", "ts"])
    np.testing.assert_allclose(back["y"], back["load_actual_mw"])
    np.testing.assert_allclose(back["yhat"], back["load_actual_mw"] + 1)


def test_array_gram_equals_the_gram_of_columns(spark):
    r = np.random.default_rng(6)
    x = pd.DataFrame(r.normal(size=(500, 4)), columns=["a", "b", "c", "y"])
    x["g"], x["k"] = np.where(x["a"] > 0, "p", None), (x["b"] > 0).astype("int32")
    df = spark.createDataFrame(x).repartition(5)
    want = gram_table(df, ["g", "k"], ["a", "b", "c"], "y").toPandas()
    got = gram_of_arrays(df.withColumn("v", F.array("a", "b", "c")), ["g", "k"], "v", "y", 3).toPandas()
    both = want.merge(got, on=["g", "k"], suffixes=("", "_2"))
    assert len(both) == len(want) == len(got) == 4
    for c in ("n", "sy", "syy", "sx", "sxy", "sxx"):
        np.testing.assert_allclose(np.stack(both[c].to_list()), np.stack(both[f"{c}_2"].to_list()), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("name, most", [("e6_mondrian_widths", 2), ("i22_conformal_pass", 3), ("i28_supply_master", 2)])
def test_sources_are_not_read_again(spark, name, most):
    assert len(re.findall(r"\(\d+\) Scan parquet", plan_of(E.queries()[name](spark, SF)))) <= most
