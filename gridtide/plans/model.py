"""Boosted-tree regression with Spark ML."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: parameter name -> (GBTRegressor parameter, conversion)
PARAMS = {
    "num_trees": ("maxIter", int),
    "learning_rate": ("stepSize", float),
    "max_depth": ("maxDepth", int),
    "feature_fraction": ("featureSubsetStrategy", lambda v: str(float(v))),
}
#: accepted for compatibility: Spark grows trees level by level and has no limit on leaves
UNUSED = ("num_leaves",)


def regressor(features: Sequence[str], label: str, params: Mapping[str, object] | None = None, seed: int = 0) -> Pipeline:
    """Unfitted pipeline: assemble the feature columns, then boosted trees on squared error."""
    made = {}
    for name, value in (params or {}).items():
        if name in UNUSED:
            warnings.warn(f"{name} has no counterpart in level-wise trees and is not used", stacklevel=2)
        elif name in PARAMS:
            target, convert = PARAMS[name]
            made[target] = convert(value)
        else:
            raise ValueError(f"unknown parameter: {name}")
    # null features become NaN, which a tree split can handle
    assemble = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assemble, GBTRegressor(labelCol=label, lossType="squared", seed=seed, **made)])


def fit_regressor(
    df: DataFrame, features: Sequence[str], label: str, params: Mapping[str, object] | None = None, seed: int = 0
) -> PipelineModel:
    """Fit on rows with a known label. Only feature and label columns are read."""
    rows = df.select(*features, F.col(label).cast("double").alias(label)).filter(F.col(label).isNotNull())
    return regressor(features, label, params, seed).fit(rows)


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Add the prediction; helper columns are dropped."""
    made = model.transform(df).drop("features")
    return made if out == "prediction" else made.withColumnRenamed("prediction", out)


def feature_columns(model: PipelineModel) -> list[str]:
    """Names the model was fitted on."""
    return next(s.getInputCols() for s in model.stages if isinstance(s, VectorAssembler))
