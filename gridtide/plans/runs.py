"""Training runs as a table."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.operators.metrics import mae
from gridtide.operators.ordering import best_row
from gridtide.plans.model import feature_columns, fit_regressor, predict
from gridtide.sources.readers import exists

RUNS = (
    "run_id STRING, experiment_id STRING, status STRING, artifact_uri STRING, start_time BIGINT, end_time BIGINT, "
    "metrics MAP<STRING, DOUBLE>, params MAP<STRING, STRING>, tags MAP<STRING, STRING>, deleted BOOLEAN"
)


def run_name(trial: int | None, now: datetime | None = None) -> str:
    """``TrialNumber7-20240101T120000UTC``, or ``DefaultParameters-…`` without a trial."""
    now = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return f"{'DefaultParameters' if trial is None else f'TrialNumber{trial}'}-{now:%Y%m%dT%H%M%S}UTC"


def evaluate_run(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    store: str,
    experiment: str,
    params: Mapping[str, object] | None = None,
    trial: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Fit, measure, save the model with one example row, and append the run to the table under ``store``. Returns the run."""
    spark = train.sparkSession
    run_id, started = uuid.uuid4().hex, datetime.now(timezone.utc)
    begin = time.time()
    model = fit_regressor(train, features, label, params, seed)
    duration = time.time() - begin
    metrics = {
        "train_mae": mae(predict(model, train), label, "prediction").first()["mae"],
        "test_mae": mae(predict(model, test), label, "prediction").first()["mae"],
        "training_duration": duration,
    }
    uri = f"{store.rstrip('/')}/artifacts/{run_id}"
    model.write().overwrite().save(f"{uri}/model")
    predict(model, train.select(*features).limit(1)).coalesce(1).write.mode("overwrite").parquet(f"{uri}/example")
    signature = T.StructType([train.schema[c] for c in features]).simpleString()
    row = (
        run_id, experiment, "FINISHED", uri, int(started.timestamp() * 1000), int(time.time() * 1000),
        metrics, {k: str(v) for k, v in (params or {}).items()},
        {"run_name": run_name(trial, started), "inputs": signature, "outputs": "double"}, False,
    )
    run = spark.createDataFrame([row], RUNS)
    log_runs(run, store)
    return run


def log_runs(runs: DataFrame, store: str) -> None:
    runs.coalesce(1).write.mode("append").parquet(f"{store.rstrip('/')}/runs")


def search_runs(spark: SparkSession, store: str, experiment: str | None = None, deleted: bool = False) -> DataFrame:
    """Runs of an experiment, newest first."""
    store = store.rstrip("/")
    runs = spark.read.schema(RUNS).parquet(f"{store}/runs")
    if experiment is not None:
        runs = runs.filter(F.col("experiment_id") == experiment)
    if exists(spark, f"{store}/deleted_runs"):
        gone = spark.read.schema("run_id STRING").parquet(f"{store}/deleted_runs").distinct()
        gone = gone.withColumn("_gt_gone", F.lit(True))
        runs = runs.join(gone, "run_id", "left").withColumn("deleted", F.col("deleted") | F.coalesce("_gt_gone", F.lit(False)))
        runs = runs.drop("_gt_gone")
    runs = runs.select(*T.StructType.fromDDL(RUNS).names)
    return (runs if deleted else runs.filter("NOT deleted")).orderBy(F.desc("start_time"), "run_id")


def metric(name: str):
    return F.col("metrics")[name]


def mark_duplicates(runs: DataFrame, cols: Sequence[str], key: str = "run_id", newest: str = "start_time") -> DataFrame:
    """Add ``duplicate``: true for all but the newest run (then the smallest key) among those equal in ``cols``.

    Runs with a null among ``cols`` are no duplicates. The keeper of each group is an aggregate, and runs meet the keepers
    on their own key, so a large group of equal runs stays spread out.
    """
    known = F.lit(True)
    for c in cols:
        known = known & F.col(c).isNotNull()
    first = F.min(F.struct((-F.col(newest)).alias("age"), F.col(key).alias(key)))
    keepers = runs.filter(known).groupBy(*cols).agg(first.alias("first")).select(f"first.{key}")
    keepers = keepers.withColumn("_gt_keeper", F.lit(True))
    out = runs.join(keepers, key, "left")
    flag = known & F.col("_gt_keeper").isNull()
    return out.withColumn("duplicate", flag).select(*runs.columns, "duplicate")


def dedupe_runs(runs: DataFrame, cols: Sequence[str], key: str = "run_id", newest: str = "start_time") -> DataFrame:
    return mark_duplicates(runs, cols, key, newest).filter("NOT duplicate").drop("duplicate")


def delete_duplicate_runs(
    spark: SparkSession, store: str, experiment: str, metrics: Sequence[str] = ("train_mae", "test_mae")
) -> int:
    """Mark all but the newest of the runs with equal metrics as deleted; returns how many."""
    runs = search_runs(spark, store, experiment).withColumns({f"_gt_{m}": metric(m) for m in metrics})
    extra = mark_duplicates(runs, [f"_gt_{m}" for m in metrics]).filter("duplicate").select("run_id")
    n = extra.count()
    if n:
        extra.coalesce(1).write.mode("append").parquet(f"{store.rstrip('/')}/deleted_runs")
    return n


def promote_best(
    spark: SparkSession, store: str, experiment: str, name: str = "champion", by: str = "test_mae"
) -> DataFrame:
    """Copy the model of the run with the lowest metric to ``store/name`` with its metadata; returns its (ids, time) row."""
    runs = search_runs(spark, store, experiment).withColumn("_gt_metric", metric(by))
    best = best_row(runs, "_gt_metric", ties=["run_id"]).drop("_gt_metric").collect()
    if not best:
        raise ValueError(f"no run with a known {by}")
    run = best[0]
    home = f"{store.rstrip('/')}/{name}"
    PipelineModel.load(f"{run['artifact_uri']}/model").write().overwrite().save(f"{home}/model")
    spark.createDataFrame(best, RUNS).coalesce(1).write.mode("overwrite").json(f"{home}/metadata")
    row = spark.createDataFrame(
        [(experiment, run["run_id"], int(time.time() * 1000))], "experiment_id STRING, run_id STRING, promoted_at BIGINT"
    )
    row.coalesce(1).write.mode("append").parquet(f"{home}/history")
    return row


def load_champion(store: str, name: str = "champion") -> PipelineModel:
    return PipelineModel.load(f"{store.rstrip('/')}/{name}/model")


def validate_model(model: PipelineModel | str, example: DataFrame) -> DataFrame:
    """Score a stored example (features and the prediction they had): the example, ``again`` and ``valid``."""
    loaded = PipelineModel.load(model) if isinstance(model, str) else model
    inputs = example.withColumnRenamed("prediction", "expected")
    again = predict(loaded, inputs.select(*feature_columns(loaded), "expected"), "again")
    return again.withColumn("valid", F.col("again").eqNullSafe(F.col("expected")))
