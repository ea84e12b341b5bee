"""E5 and E6 over the driver tables: every model has its quantiles and widths."""

import math

import pytest

import __spark_entry__ as E
from gridcast.plans.q_aggs import MODELS, predictions
from gridcast.plans.registry import Tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def residuals(spark):
    p = predictions(Tables(spark, SF)).selectExpr(
        "series_id", "model", "hour(from_utc_timestamp(ts, 'Europe/Sofia')) AS hour", "abs(y - yhat) AS a").collect()
    cells = {}
    for r in p:
        cells.setdefault((r["series_id"], r["model"]), []).append(r["a"])
        cells.setdefault((r["series_id"], r["model"], r["hour"]), []).append(r["a"])
    return cells


def ranked(a):
    return sorted(a)[min(math.ceil((len(a) + 1) * 0.9), len(a)) - 1]


def test_quantiles_of_every_model(spark, residuals):
    got = {(r["series_id"], r["model"]): (r["m"], r["q"])
           for r in E.queries()["e5_conformal_quantile"](spark, SF).collect()}
    want = {k: (len(a), ranked(a)) for k, a in residuals.items() if len(k) == 2}
    assert {m for _, m in got} == set(MODELS) and got.keys() == want.keys()
    assert all(got[k][0] == n and got[k][1] == pytest.approx(q, abs=1e-6) for k, (n, q) in want.items())


def test_widths_of_every_model_and_hour(spark, residuals):
    got = {(r["series_id"], r["model"], r["hour"]): r["w"]
           for r in E.queries()["e6_mondrian_widths"](spark, SF).collect()}
    want = {(*k, h): ranked(residuals.get((*k, h), a)) for k, a in residuals.items() if len(k) == 2 for h in range(24)}
    assert {m for _, m, _ in got} == set(MODELS) and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(w, abs=1e-6) for k, w in want.items())
