"""Prediction errors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.operators.order_stats import known


def mae(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """One row: mean absolute error of the rows that have both. NaN counts as null."""
    return df.agg(F.avg(F.abs(known(df, y) - known(df, yhat))).alias("mae"))
