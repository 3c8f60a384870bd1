"""Time-ordered cross-validation and parameter sweeps."""

from __future__ import annotations

import math
import random
import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridtide.operators.metrics import mae
from gridtide.operators.ordering import best_row, sort_by, top_k
from gridtide.plans.model import regressor
from gridtide.session import scratch
from gridtide.sources.readers import exists
from gridtide.spec import BacktestSpec

TRIALS = "number INT, value DOUBLE, params MAP<STRING, DOUBLE>, fold_errors ARRAY<DOUBLE>, cv_errors_std DOUBLE, study STRING"

# fixed values: default search space of the boosted trees
SPACE = (
    {"name": "num_trees", "low": 3, "high": 10, "kind": "int"},
    {"name": "max_depth", "low": 3, "high": 10, "kind": "int"},
    {"name": "num_leaves", "low": 5, "high": 25, "kind": "int"},
    {"name": "learning_rate", "low": 0.001, "high": 0.1, "kind": "float", "log": True},
    {"name": "feature_fraction", "low": 0.1, "high": 0.75, "kind": "float"},
)

#: tasks for each core at which more fits side by side would only take memory
TASKS = 4


def fold_error(df: DataFrame, estimator: Estimator, label: str, fold: int) -> float:
    """MAE on ``block = fold`` of a model fitted on all earlier blocks (see ``expanding_folds``)."""
    model = estimator.fit(df.filter(F.col("block") < fold))
    return mae(model.transform(df.filter(F.col("block") == fold)), label, "prediction").first()["mae"]


def _fold_errors(
    df: DataFrame, estimators: Sequence[Estimator], label: str, k: int, parallel: int
) -> list[list[float]]:
    """Errors per estimator and fold. Fits run side by side: a fit is many short jobs, which leave the cluster idle alone.

    Each holds its rows in memory, so there are only as many (two at least) as give each core ``TASKS`` tasks to work off.
    """
    jobs = [(e, fold) for e in estimators for fold in range(1, k + 1)]
    parallel = min(parallel, _side_by_side(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()))
    run = inheritable_thread_target(df.sparkSession)(lambda job: fold_error(df, job[0], label, job[1]))
    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(jobs)))) as pool:
        errors = list(pool.map(run, jobs))
    return [errors[i * k : (i + 1) * k] for i in range(len(estimators))]


def _side_by_side(cores: int, parts: int) -> int:
    return max(2, math.ceil(TASKS * cores / max(1, parts)))


def _mean(errors: Sequence[float]) -> float:
    return sum(errors) / len(errors)


def _std(errors: Sequence[float]) -> float:
    """Population standard deviation."""
    m = _mean(errors)
    return math.sqrt(sum((e - m) ** 2 for e in errors) / len(errors))


def _assembly(estimator: Estimator) -> tuple[tuple | None, VectorAssembler | None, Estimator]:
    """The assembly of features that a pipeline begins with (its settings, and itself), and what is left to fit."""
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else []
    if len(stages) < 2 or not isinstance(stages[0], VectorAssembler):
        return None, None, estimator
    head = stages[0]
    return (tuple(head.getInputCols()), head.getOutputCol(), head.getHandleInvalid()), head, Pipeline(stages=stages[1:])


def _fold_rows(
    df: DataFrame, estimators: Sequence[Estimator], label: str, cols: Sequence[str] | None = None
) -> tuple[DataFrame, list[Estimator]]:
    """The rows that belong to a fold, written once by block: a fit reads its blocks only, and memory is left to the fits.

    If all estimators begin with the same assembly of features, it is done here, once, and the estimators come without it.
    """
    cols = [c for c in (cols if cols is not None else df.columns) if c not in (label, "block")]
    rows = df.select(*cols, F.col(label).cast("double").alias(label), "block")
    rows = rows.filter(F.col(label).isNotNull() & F.col("block").isNotNull())
    parts = [_assembly(e) for e in estimators]
    if len({settings for settings, _, _ in parts}) == 1 and parts[0][1] is not None:
        rows, estimators = parts[0][1].transform(rows), [rest for _, _, rest in parts]
    path = scratch(df.sparkSession, "folds")
    rows.write.partitionBy("block").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path), list(estimators)


def backtest(
    df: DataFrame,
    estimator: Estimator,
    label: str,
    k: int = BacktestSpec().n_folds,
    features: Sequence[str] | None = None,
    parallel: int = 4,
) -> DataFrame:
    """One row per fold (``fold``, ``mae``) with the mean and population std of all folds beside it.

    Name the ``features`` to write these columns only.
    """
    errors = _fold_errors(*_fold_rows(df, [estimator], label, features), label, k, parallel)[0]
    out = [(i, e, _mean(errors), _std(errors)) for i, e in enumerate(errors, 1)]
    return df.sparkSession.createDataFrame(out, "fold INT, mae DOUBLE, cv_mean DOUBLE, cv_std DOUBLE")


def sample_params(space: Sequence[Mapping], n: int, seed: int = 0, first: int = 0) -> list[dict[str, float]]:
    """``n`` random draws. Draw i depends on ``seed`` and i only, so a study that is continued does not repeat itself."""
    draws = []
    for i in range(first, first + n):
        rng = random.Random(f"{seed}/{i}")
        draw = {}
        for p in space:
            if p["kind"] == "int":
                draw[p["name"]] = rng.randint(p["low"], p["high"])
            elif p.get("log"):
                draw[p["name"]] = math.exp(rng.uniform(math.log(p["low"]), math.log(p["high"])))
            else:
                draw[p["name"]] = rng.uniform(p["low"], p["high"])
        draws.append(draw)
    return draws


def sweep(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    space: Sequence[Mapping] = SPACE,
    n_trials: int = BacktestSpec().n_trials,
    k: int = BacktestSpec().n_folds,
    seed: int = BacktestSpec().seed,
    study: str = "study",
    path: str | None = None,
    estimator_fn: Callable[[Mapping[str, float]], Estimator] | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Random search over the folds of ``df`` (with ``block``); one row per trial.

    Only the feature, label and block columns are written, once for all fits; trials and folds run side by side. With
    ``path`` the trials are appended to that table and numbering goes on from the study's earlier trials.
    """
    spark = df.sparkSession
    first = trials_table(spark, path, study).count() if path and exists(spark, path) else 0
    draws = sample_params(space, n_trials, seed, first)
    make = estimator_fn or (lambda params: regressor(features, label, params, seed))

    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        estimators = [make(params) for params in draws]
    errors = _fold_errors(*_fold_rows(df, estimators, label, features), label, k, parallel)
    done = [
        (first + i, _mean(e), {p: float(v) for p, v in params.items()}, e, _std(e), study)
        for i, (params, e) in enumerate(zip(draws, errors, strict=True))
    ]
    trials = spark.createDataFrame(done, TRIALS)
    if path:
        trials.coalesce(1).write.mode("append").partitionBy("study").parquet(path)
    return trials


def trials_table(spark: SparkSession, path: str, study: str | None = None) -> DataFrame:
    """Trials in order, with the best value so far."""
    trials = spark.read.parquet(path).withColumn("study", F.col("study").cast("string"))
    if study is not None:
        trials = trials.filter(F.col("study") == study)
    return with_best_so_far(trials)


def with_best_so_far(trials: DataFrame) -> DataFrame:
    w = Window.partitionBy("study").orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return sort_by(trials.withColumn("best_value", F.min("value").over(w)), ["study", "number"])


def best_trial(trials: DataFrame) -> DataFrame:
    return best_row(trials, "value", ties=["number"])


def best_params(trials: DataFrame) -> dict[str, float]:
    row = best_trial(trials).first()
    if row is None:
        raise ValueError("the study has no trials")
    return dict(row["params"])


def top_trials(trials: DataFrame, k: int = 10) -> DataFrame:
    return top_k(trials, "value", k, ties=["number"])
