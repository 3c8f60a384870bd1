"""Scoring an unbounded source of requests."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from gridtide.plans.scoring import score_rows


def request_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: str = "request BIGINT, payload STRING", **options) -> DataFrame:
    """Requests that arrive as files."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def score_stream(
    model: PipelineModel,
    requests: DataFrame,
    sink: str,
    checkpoint: str,
    request: str = "request",
    payload: str = "payload",
    available_now: bool = False,
    every: str = "10 seconds",
) -> StreamingQuery:
    """Start a query that appends one row per scored row, and one per bad request, to a parquet table.

    Stateless: nothing is kept between batches but the source position in ``checkpoint``, and each input row is written once
    also after a restart. Features come with the request, as lags cannot be computed on a stream without state.
    """
    if not requests.isStreaming:
        raise ValueError("score_stream needs a streaming DataFrame")
    writer = score_rows(model, requests, request, payload).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)
    return writer.start(sink)
