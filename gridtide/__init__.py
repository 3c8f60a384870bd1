"""Panel time-series analytics on Spark DataFrames."""

from gridtide.spec import BacktestSpec, FeatureSpec, LagTransform, SeriesSpec

__all__ = ["BacktestSpec", "FeatureSpec", "LagTransform", "SeriesSpec"]
