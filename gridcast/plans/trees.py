"""Supply models with Spark MLlib, significant-feature matrix.

Each tree ensemble of I7 is a distributed MLlib job (binned splits). The boosted trees of
the walk-forward are in ``boosting.py``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import standardize, standardized_metrics
from ..session import cut_lineage
from .folds import chronological_split
from .linear import fixed_linear

# --- fixed values (reference hyper-parameters) ------------------------------------------
SUPPLY_LINEAR = (("Lasso", 0.01, 1.0), ("Ridge", 1.0, 0.0), ("ElasticNet", 0.01, 0.5))
SUPPLY_TREES = {"DecisionTree": dict(maxDepth=10, minInstancesPerNode=30, seed=42),
                "RandomForest": dict(numTrees=100, maxDepth=10, minInstancesPerNode=30, featureSubsetStrategy="all",
                                     seed=42),
                "GradientBoosting": dict(maxIter=100, maxDepth=10, minInstancesPerNode=30, seed=42)}
IMPORTANCE_MIN = 0.005
# ------------------------------------------------------------------------------------------


def make_tree(kind: str, **params):
    cls = {"DecisionTree": DecisionTreeRegressor, "RandomForest": RandomForestRegressor,
           "GradientBoosting": GBTRegressor}[kind]
    return cls(featuresCol="_features", labelCol="_label", **params)


def supply_models(table: DataFrame, ts: str, target: str, features: Sequence[str], split: str,
                  trees: dict | None = None) -> DataFrame:
    """Every supply model fitted before ``split`` and scored from it on, in standard units.

    Each side is standardised by its own mean and std (0/1 columns stay), as the reference
    does. Models: SUPPLY_LINEAR at their fixed penalties, the ``trees`` (default SUPPLY_TREES)
    and ``naive``, the last training value. One row per model: n, MSE, RMSE, MAE, MAPE.
    """
    cols, trees = list(features), SUPPLY_TREES if trees is None else trees
    asm = VectorAssembler(inputCols=cols, outputCol="_features")
    tr, te = (cut_lineage(asm.transform(standardize(part.select(ts, target, *cols).dropna(), [target, *cols], ddof=1,
                                                    keep_dummies=True).withColumnRenamed(target, "_label")))
              for part in chronological_split(table, ts, split))
    linear = te.crossJoin(F.broadcast(fixed_linear(tr, cols, "_label", SUPPLY_LINEAR)))  # three rows of coefficients
    dot = F.aggregate(F.zip_with("beta", F.array(*cols), lambda b, v: b * v), F.col("intercept"), lambda t, v: t + v)
    scored = linear.select("model", "_label", dot.alias("yhat"))
    last = tr.agg(F.max_by("_label", ts).alias("yhat"))
    scored = scored.unionByName(te.crossJoin(F.broadcast(last)).select(F.lit("naive").alias("model"), "_label", "yhat"))
    for kind, params in trees.items():
        fitted = make_tree(kind, **params).fit(tr)
        scored = scored.unionByName(fitted.transform(te).select(F.lit(kind).alias("model"), "_label",
                                                                F.col("prediction").alias("yhat")))
    n = te.agg(F.count(F.lit(1)).alias("n"))
    return standardized_metrics(scored, ["model"], "_label", "yhat").crossJoin(F.broadcast(n))


def significant_features(ols_p: DataFrame, coefs: DataFrame, importances: DataFrame, features: Sequence[str],
                         corr: DataFrame | None = None) -> DataFrame:
    """Which features each model relies on — OLS p < 0.05, |coef| > 1e-6 (lasso /
    elastic net, last fold), tree importance > 0.005 (mean over folds). ``corr(feature,
    corr)``, if given, adds each feature's correlation with the target."""
    lin = ols_p.filter((F.col("feature") != "const") & (F.col("p") < 0.05)).select(
        "feature", F.lit("OLS").alias("model")).distinct()
    c = coefs.select("model", "fold_id", F.posexplode("beta").alias("i", "b"))
    names = F.array(*[F.lit(f) for f in features])
    last = coefs.groupBy("model").agg(F.max("fold_id").alias("fold_id"))
    sparse = (c.join(last, ["model", "fold_id"]).filter(F.abs("b") > 1e-6)
              .select(F.element_at(names, F.col("i") + 1).alias("feature"), "model").distinct())
    tr = (importances.groupBy("model", "feature").agg(F.avg("importance").alias("imp"))
          .filter(F.col("imp") > IMPORTANCE_MIN).select("feature", "model"))
    out = lin.unionByName(sparse).unionByName(tr).withColumn("selected", F.lit(1))
    return out if corr is None else out.join(corr, "feature", "left")
