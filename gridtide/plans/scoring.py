"""Scoring requests with a fitted model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.plans.model import feature_columns, predict
from gridtide.sources.payload import from_split_json


def score_rows(model: PipelineModel, requests: DataFrame, request: str, payload: str) -> DataFrame:
    """One row per scored row: (request, ``row``, ``prediction``, ``error``); a request that cannot be scored gives one error row.

    Works row by row, on batches and streams alike.
    """
    rows = from_split_json(requests, payload, feature_columns(model), keep=[request])
    scored = predict(model, rows)
    usable = F.col("error").isNull()
    return scored.select(request, "row", F.when(usable, F.col("prediction")).alias("prediction"), "error")


def score_batch(model: PipelineModel, requests: DataFrame, request: str = "request", payload: str = "payload") -> DataFrame:
    """One answer per request: (request, ``predictions`` in row order, ``error``). Request ids are unique."""
    rows = score_rows(model, requests, request, payload)
    ordered = F.array_sort(F.collect_list(F.when(F.col("error").isNull(), F.struct("row", "prediction"))))
    answers = rows.groupBy(request).agg(ordered.alias("scored"), F.max("error").alias("error"))
    predictions = F.when(F.col("error").isNull(), F.transform("scored", lambda s: s["prediction"]))
    return answers.select(request, predictions.alias("predictions"), "error")
