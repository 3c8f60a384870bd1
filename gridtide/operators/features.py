"""Lag, rolling, expanding and calendar features.

Lags count rows of the series, not time, so a series should be contiguous (see ``densify``, ``drop_discontinuous``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.functions.dates import add_date_features
from gridtide.operators.layout import POS, chunk_of, known_keys, once, over_series, settle
from gridtide.operators.order_stats import known
from gridtide.operators.scans import MONOIDS, SMALL_WINDOW, Monoid, ewm_mean, framed, rolled
from gridtide.session import stage
from gridtide.spec import FeatureSpec, LagTransform, SeriesSpec

_CHECKED, _IS_HISTORY = "_gt_checked", "_gt_is_history"
_TOTALS = ("sum", "n")
#: the default of Spark's group-limit threshold
GROUP_LIMIT = 1000


def _lag_columns(w: Window, target: str, lags: Sequence[int], naming: str) -> dict[str, Column]:
    return {naming.format(k=k, col=target): F.lag(target, k).over(w) for k in lags}


def _expanding(w: Window, totals, target: str, lag: int) -> Column:
    if totals is None:
        return F.avg(target).over(w.rowsBetween(Window.unboundedPreceding, -lag))
    # in a cut series: the running totals of the row ``lag`` rows back
    return F.lag(F.col(totals["sum"]) / F.nullif(F.col(totals["n"]), F.lit(0)), lag).over(w)


def _scans(transforms: Sequence[LagTransform], target: str) -> dict[str, tuple[Monoid, str]]:
    """Running values that the expanding and weighted transforms are lags of."""
    kinds = {t.kind: MONOIDS[t.statistic] for t in transforms if t.kind.startswith("expanding")}
    kinds |= {f"ewm_{t.alpha}": ewm_mean(t.alpha) for t in transforms if t.alpha is not None}
    return {f"_gt_{k.replace('.', '_')}": (m, target) for k, m in kinds.items()}


def _windows(transforms: Sequence[LagTransform], target: str) -> dict[str, tuple[Monoid, str, int]]:
    """What rolling transforms over long windows are merged from."""
    return {f"_gt_{t.statistic}_{t.window}": (MONOIDS[t.statistic], target, t.window) for t in transforms if (t.window or 0) > SMALL_WINDOW}


def _transform(w: Window, t: LagTransform, target: str) -> Column:
    if t.alpha is not None:
        return F.lag(f"_gt_ewm_{t.alpha}".replace(".", "_"), t.lag).over(w)
    if t.window is None:
        return F.lag(f"_gt_{t.kind}", t.lag).over(w)
    if t.window > SMALL_WINDOW:
        return rolled(w, POS, f"_gt_{t.statistic}_{t.window}", MONOIDS[t.statistic], t.lag, t.window)
    return framed(w, target, MONOIDS[t.statistic], t.lag, t.window)


def _running_totals(target: str) -> dict[str, tuple[str, str]]:
    return {"sum": ("sum", target), "n": ("sum", "_gt_known")}


def add_lags(
    df: DataFrame, spec: SeriesSpec, lags: Sequence[int], naming: str = "lag{k}", dropna: bool = False
) -> DataFrame:
    """Add the target ``k`` rows earlier in its series, as it is. ``naming`` may use ``{k}`` and ``{col}``."""
    rows = known_keys(df, spec.keys)
    spec = settle(rows, spec)
    out = over_series(rows, spec, max(lags), lambda w, _: _lag_columns(w, spec.target, lags, naming))
    return out.na.drop("any") if dropna else out


def add_expanding_mean(df: DataFrame, spec: SeriesSpec, lag: int) -> DataFrame:
    """Add ``expanding_mean_lag{lag}``: mean of everything up to ``lag`` rows back. NaN counts as null."""
    rows = known_keys(df, spec.keys)
    spec = settle(rows, spec)
    value = known(rows, spec.target)
    rows = rows.withColumn(_CHECKED, value).withColumn("_gt_known", value.isNotNull().cast("bigint"))
    out = over_series(
        rows,
        spec,
        lag,
        lambda w, totals: {f"expanding_mean_lag{lag}": _expanding(w, totals, _CHECKED, lag)},
        totals=_running_totals(_CHECKED),
    )
    return out.drop("_gt_known", _CHECKED)


def add_transforms(df: DataFrame, spec: SeriesSpec, transforms: Sequence[LagTransform]) -> DataFrame:
    """Add each transform under its name; NaN counts as null, which expanding transforms skip and which empties every rolling window that holds it.

    Expanding and weighted values are scans of mergeable states, carried from piece to piece of a series. A rolling value costs the same for
    each row however long its window is. An exponentially weighted mean needs a value in every row.
    """
    rows = known_keys(df, spec.keys)
    spec = settle(rows, spec)
    value = known(rows, spec.target)
    if any(t.alpha is not None for t in transforms):
        value = F.when(value.isNull(), F.raise_error(F.lit("exponentially weighted mean: null target"))).otherwise(value)
    out = over_series(
        rows.withColumn(_CHECKED, value),
        spec,
        max(t.reach for t in transforms),
        lambda w, _: {t.name: _transform(w, t, _CHECKED) for t in transforms},
        scans=_scans(transforms, _CHECKED),
        windows=_windows(transforms, _CHECKED),
    )
    return out.drop(_CHECKED)


def add_rolling_mean(df: DataFrame, spec: SeriesSpec, lag: int, window: int) -> DataFrame:
    """Add ``rolling_mean_lag{lag}_window_size{window}``: mean of lags ``lag`` … ``lag+window-1``, null until all exist. NaN counts as null."""
    return add_transforms(df, spec, [LagTransform("rolling_mean", lag, window)])


def feature_names(features: FeatureSpec) -> list[str]:
    """Names of the lag and lag-transform columns, in table order."""
    names = [f"lag{k}" for k in features.lags]
    for lag in features.transform_lags:
        if features.expanding:
            names.append(f"expanding_mean_lag{lag}")
        names += [f"rolling_mean_lag{lag}_window_size{w}" for w in features.rolling_windows]
    return names + [t.name for t in features.transforms if t.name not in names]


def _all_transforms(features: FeatureSpec) -> list[LagTransform]:
    """The rolling means that lags share, and the transforms of their own, each once."""
    shared = [LagTransform("rolling_mean", lag, w) for lag in features.transform_lags for w in features.rolling_windows]
    return [*shared, *[t for t in features.transforms if t not in shared]]


def series_tail(df: DataFrame, spec: SeriesSpec, n: int) -> DataFrame:
    """The last ``n`` rows of every series.

    Spark keeps at most ``n`` rows per series in each map task before the shuffle, up to the session's group-limit threshold. For a longer tail
    the pieces of a series are counted, and only those from the end on that are needed are read: n rows and those of one piece at most.
    """
    df = known_keys(df, spec.keys)
    if n > GROUP_LIMIT:
        pieces = once(df, spec.with_(layout="chunked")).withColumn("_gt_piece", chunk_of(spec))
        counts = stage(pieces.groupBy(*spec.keys, "_gt_piece").agg(F.count(F.lit(1)).alias("_gt_n")), "pieces")
        after = Window.partitionBy(*spec.keys).orderBy(F.col("_gt_piece").desc()).rowsBetween(Window.unboundedPreceding, -1)
        needed = counts.withColumn("_gt_after", F.coalesce(F.sum("_gt_n").over(after), F.lit(0))).filter(F.col("_gt_after") < n)
        df = pieces.join(needed.select(*spec.keys, "_gt_piece"), [*spec.keys, "_gt_piece"], "left_semi").drop("_gt_piece")
    w = Window.partitionBy(*spec.keys).orderBy(F.col(spec.time).desc_nulls_last())
    last = df.withColumn("_gt_rn", F.row_number().over(w))
    return last.filter(F.col("_gt_rn") <= n).drop("_gt_rn")


def make_features(
    df: DataFrame,
    spec: SeriesSpec,
    features: FeatureSpec = FeatureSpec(),
    history: DataFrame | None = None,
    dropna: bool = True,
) -> DataFrame:
    """All features of ``features`` at once; all other columns are kept.

    Rows that lack a lag or a rolling value (the head of each series) are dropped unless ``dropna=False``. With
    ``history`` the last rows of that earlier table go on top of each series first, so no row of ``df`` is
    lost; the expanding mean then starts at the first of those rows. A null target, or NaN, is an error.
    """
    rows = known_keys(df, spec.keys)
    if history is not None:
        tail = series_tail(history, spec, features.reach).withColumn(_IS_HISTORY, F.lit(True))
        rows = rows.withColumn(_IS_HISTORY, F.lit(False)).unionByName(tail, allowMissingColumns=True)
    spec = settle(rows, spec)
    target = known(rows, spec.target)
    rows = rows.withColumn(
        _CHECKED, F.when(target.isNull(), F.raise_error(F.lit("make_features: null target"))).otherwise(target)
    ).withColumn("_gt_known", F.lit(1).cast("bigint"))

    transforms = _all_transforms(features)

    def build(w, totals):
        made = {f"lag{k}": F.lag(_CHECKED, k).over(w) for k in features.lags}
        for lag in features.transform_lags:
            if features.expanding:
                made[f"expanding_mean_lag{lag}"] = _expanding(w, totals, _CHECKED, lag)
            made |= {t.name: _transform(w, t, _CHECKED) for t in transforms if t.kind == "rolling_mean" and t.lag == lag}
        return made | {t.name: _transform(w, t, _CHECKED) for t in transforms if t.name not in made}

    totals = _running_totals(_CHECKED) if features.expanding and features.transform_lags else None
    out = over_series(rows, spec, features.reach, build, totals, _scans(transforms, _CHECKED), _windows(transforms, _CHECKED))
    if history is not None:
        out = out.filter(~F.col(_IS_HISTORY)).drop(_IS_HISTORY)
    out = out.drop(_CHECKED, "_gt_known")
    if dropna:
        out = out.na.drop("any", subset=feature_names(features))
    return add_date_features(out, spec.time, features.date_parts)
