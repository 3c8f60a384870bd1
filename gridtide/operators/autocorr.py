"""Autocorrelation and partial autocorrelation of every series at once."""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.operators.layout import cut, known_keys, over_series, series_stats, settle
from gridtide.operators.order_stats import known
from gridtide.spec import SeriesSpec

_SUM, _N, _ROWS, _X, _NEAR = "_gt_sum", "_gt_n", "_gt_rows", "_gt_x", "_gt_near"


def _correlations(df: DataFrame, spec: SeriesSpec, nlags: int, adjusted: bool) -> DataFrame:
    """One row per series: keys, ``n`` and the array ``acf`` of lags 0 … nlags."""
    rows = known_keys(df, spec.keys).select(*spec.keys, spec.time, known(df, spec.target).alias(spec.target))
    spec = settle(rows, spec)
    rows = series_stats(
        cut(rows.withColumn(_ROWS, F.lit(1)), spec),
        spec,
        {_SUM: ("sum", spec.target), _N: ("count", spec.target), "_gt_all": ("count", _ROWS)},
    )
    # a series with a null has no autocorrelation
    rows = rows.withColumn(_X, F.when(F.col(_N) == F.col("_gt_all"), F.col(spec.target) - F.col(_SUM) / F.col(_N)))
    rows = rows.drop(spec.target, _ROWS, _SUM, _N, "_gt_all")
    # each row meets itself and its predecessors; the products are summed place by place, in map tasks first, without a row for each lag.
    # A series with nulls has products of zero, and so no variance
    near = over_series(rows, spec, nlags, lambda w, _: {_NEAR: F.collect_list(_X).over(w.rowsBetween(-nlags, Window.currentRow))})
    products = F.transform(F.sequence(F.lit(0), F.lit(nlags)), lambda k: F.coalesce(F.get(_NEAR, F.size(_NEAR) - 1 - k) * F.col(_X), F.lit(0.0)))
    per_series = near.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.sum(array_to_vector(products))).alias("s")
    )
    n = F.col("n")
    variance = F.nullif(F.get("s", F.lit(0)), F.lit(0.0)) / n

    def correlation(k):
        terms = F.nullif(F.greatest(n - k, F.lit(0)), F.lit(0)) if adjusted else n
        # a lag as long as the series has no product to sum: zero
        return F.when(k == 0, F.when(variance.isNotNull(), F.lit(1.0))).otherwise(
            F.coalesce(F.get("s", k), F.lit(0.0)) / terms / variance
        )

    lags = F.sequence(F.lit(0), F.lit(nlags))
    return per_series.select(*spec.keys, "n", F.transform(lags, correlation).alias("acf"))


def acf(df: DataFrame, spec: SeriesSpec, nlags: int, adjusted: bool = False) -> DataFrame:
    """Autocorrelation: keys, ``lag`` (0 … nlags), ``acf``. Input: contiguous series without nulls."""
    wide = _correlations(df, spec, nlags, adjusted)
    return wide.select(*spec.keys, F.posexplode("acf").alias("lag", "acf"))


def levinson_durbin(r: np.ndarray) -> np.ndarray:
    """Partial autocorrelations of each row of autocorrelations (rows × lags), by the Levinson–Durbin recursion."""
    m, width = r.shape
    out = np.ones((m, width))
    phi = np.zeros((m, width))
    error = np.ones(m)
    with np.errstate(divide="ignore", invalid="ignore"):
        for k in range(1, width):
            reflection = (r[:, k] - np.einsum("ij,ij->i", phi[:, 1:k], r[:, k - 1 : 0 : -1])) / error
            phi[:, 1:k] -= reflection[:, None] * phi[:, k - 1 : 0 : -1].copy()
            phi[:, k] = reflection
            error = error * (1.0 - reflection**2)
            out[:, k] = reflection
    out[:, 0] = r[:, 0]
    return out


def pacf(
    df: DataFrame, spec: SeriesSpec, nlags: int, method: str = "ywadjusted", alpha: float | None = 0.05
) -> DataFrame:
    """Partial autocorrelation (Yule–Walker): keys, ``lag``, ``pacf`` and, with ``alpha``, ``lower`` and ``upper``.

    ``method``: ``"ywm"`` divides each autocovariance by n, ``"ywadjusted"`` by n − lag. Only nlags+1 numbers per
    series reach Python.
    """
    if method not in ("ywm", "ywadjusted"):
        raise ValueError(f"unknown method: {method!r}")
    wide = _correlations(df, spec, nlags, adjusted=method == "ywadjusted")
    schema = T.StructType([*wide.schema.fields[:-1], T.StructField("pacf", T.ArrayType(T.DoubleType()))])

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                r = np.array([np.asarray(a, dtype=float) for a in batch["acf"]])
                solved = levinson_durbin(r)
                batch = batch.drop(columns="acf")
                batch["pacf"] = [[None if np.isnan(v) else float(v) for v in row] for row in solved]
                yield batch

    out = wide.mapInPandas(solve, schema).select(*spec.keys, "n", F.posexplode("pacf").alias("lag", "pacf"))
    if alpha is None:
        return out.drop("n")
    z = NormalDist().inv_cdf(1 - alpha / 2)
    half = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(F.lit(z) / F.sqrt("n"))
    return out.withColumns({"lower": F.col("pacf") - half, "upper": F.col("pacf") + half}).drop("n")


def top_lags(correlations: DataFrame, keys, k: int, value: str = "pacf") -> DataFrame:
    """The ``k`` lags of each series with the largest value, ranked from 1."""
    w = Window.partitionBy(*keys).orderBy(F.col(value).desc_nulls_last(), "lag")
    return correlations.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
