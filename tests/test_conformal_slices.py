"""The sliced order statistic equals sorting, also with ties, outliers and unequal groups."""

import math

import numpy as np
import pandas as pd
import pytest

from gridcast.plans.evaluate import conformal_quantile


@pytest.mark.parametrize("alpha", [0.1, 0.5, 0.001])
def test_sliced_quantile_equals_sorting(spark, alpha):
    rng = np.random.default_rng(9)
    groups = {"ties": rng.integers(0, 4, 3000).astype(float), "far": np.append(rng.normal(size=2000), 1e12),
              "same": np.full(700, 2.5), "one": np.array([-3.0]), "long": rng.lognormal(0, 3, 9000)}
    rows = pd.concat([pd.DataFrame({"g": g, "r": x}) for g, x in groups.items()])
    got = {r["g"]: (r["m"], r["q"]) for r in conformal_quantile(spark.createDataFrame(rows), ["g"], "r", alpha, slices=16).collect()}
    for g, x in groups.items():
        k = min(math.ceil((len(x) + 1) * (1 - alpha)), len(x))
        assert got[g] == (len(x), float(np.sort(np.abs(x))[k - 1]))
