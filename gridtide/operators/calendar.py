"""Regular calendars: filling a series up to its grid, and resampling onto one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.functions.steps import Step
from gridtide.operators.layout import bucket_of, cut, depth_of, in_order, known_keys, once, running, series_stats, settle
from gridtide.session import stage
from gridtide.spec import SeriesSpec

_LO, _K, _PREV_K, _AT, _FROM, _UPTO = "_gt_lo", "_gt_k", "_gt_prev_k", "_gt_at", "_gt_from", "_gt_upto"
#: grid points that are listed in one array, at most
_STRETCH = 1 << 14
#: stretches that one task makes of a part of a long gap
_FAN = 1 << 10


def duplicate_times(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Points of a series that hold more than one row, with their row count."""
    rows = known_keys(df, spec.keys)
    return rows.groupBy(*spec.keys, spec.time).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def _grid_points(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Every grid point of every series from its first to its last row: the input row, or a gap before it.

    Each row brings the empty points since its predecessor, so the calendar needs no table of its own and no join. In the chunked layout, where a
    gap may have any length, long ones are spread over tasks as ranges.
    """
    rows = known_keys(df, spec.keys).filter(F.col(spec.time).isNotNull())
    spec = settle(rows, spec)
    grid = spec.grid
    if spec.layout == "whole":
        # the running minimum is the first time; it shares the sort of the window below
        w = Window.partitionBy(*spec.keys).orderBy(*in_order(spec.time))
        rows = rows.withColumn(_LO, F.min(spec.time).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    else:
        rows = series_stats(cut(once(rows, spec), spec), spec, {_LO: ("min", spec.time)})
    rows = rows.withColumn(_K, grid.between(F.col(_LO), F.col(spec.time)))
    rows = rows.filter(grid.plus(F.col(_LO), F.col(_K)) == F.col(spec.time))
    rows = running(
        rows, spec.keys, [spec.time], {_PREV_K: ("last", _K)}, bucket_of(spec), inclusive=False, depth=depth_of(spec)
    )
    first = F.when(
        F.col(_PREV_K) == F.col(_K), F.raise_error(F.lit("densify: a series has two rows for one time"))
    ).otherwise(F.coalesce(F.col(_PREV_K) + 1, F.col(_K)))
    rows = rows.withColumn(_FROM, first)
    if spec.layout == "whole":
        # a series has at most spec.whole_limit points; a long gap in two steps, so that no row holds it whole
        return _points(_stretches(rows, F.col(_K), _STRETCH), F.col(_K), _STRETCH)
    rows = stage(rows, "gaps")
    long = F.col(_K) - F.col(_FROM) >= _STRETCH
    here = _points(rows.withColumn(_FROM, F.when(long, F.col(_K)).otherwise(F.col(_FROM))), F.col(_K), _STRETCH)
    # of a long gap only its range travels; it is cut and dealt out, twice, before there are points
    kept = [*spec.keys, _LO, _K, _FROM]
    gaps = rows.filter(long).select(*[F.col(c) if c in kept else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns])
    last, wide = F.col(_K) - 1, _STRETCH * _FAN
    dealt = _stretches(gaps, last, wide).repartition(*spec.keys, _FROM)
    dealt = dealt.withColumn(_UPTO, F.least(F.col(_FROM) + (wide - 1), last))
    dealt = _stretches(dealt, F.col(_UPTO), _STRETCH).repartition(*spec.keys, _FROM)
    return here.unionByName(_points(dealt, F.col(_UPTO), _STRETCH).drop(_UPTO))


def _stretches(rows: DataFrame, last: Column, size: int) -> DataFrame:
    """A row for each ``size`` points from ``_FROM`` to ``last``, which it starts at."""
    return rows.withColumn(_FROM, F.explode(F.sequence(F.col(_FROM), last, F.lit(size).cast("bigint"))))


def _points(rows: DataFrame, last: Column, size: int) -> DataFrame:
    """A row for each of the at most ``size`` points from ``_FROM`` to ``last``."""
    upto = F.least(F.col(_FROM) + (size - 1), last)
    return rows.withColumn(_AT, F.explode(F.sequence(F.col(_FROM), upto))).drop(_FROM)


def densify(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per series and grid point, first to last time; columns of added points are null but for the key.

    The grid of a series starts at its first row; rows between grid points are not part of it (see :func:`off_grid_rows`).
    """
    points = _grid_points(df, spec)
    time = spec.grid.plus(F.col(_LO), F.col(_AT))
    is_row = F.col(_AT) == F.col(_K)
    cols = []
    for c in df.columns:
        if c in spec.keys:
            cols.append(F.col(c))
        else:
            cols.append((time if c == spec.time else F.when(is_row, F.col(c))).alias(c))
    return points.select(*cols)


def off_grid_rows(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows that :func:`densify` leaves out: those without a time, and those between the grid points that start at a series' first time."""
    rows = known_keys(df, spec.keys)
    first = rows.groupBy(*spec.keys).agg(F.min(spec.time).alias(_LO))
    joined = rows.join(first, list(spec.keys))
    on_grid = spec.grid.plus(F.col(_LO), spec.grid.between(F.col(_LO), F.col(spec.time))) == F.col(spec.time)
    return joined.filter(~F.coalesce(on_grid, F.lit(False))).select(*[F.col(f"`{c}`") for c in df.columns])


def missing_times(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Grid points without a row."""
    points = _grid_points(df.select(*spec.keys, spec.time), spec).filter(F.col(_AT) != F.col(_K))
    return points.select(*spec.keys, spec.grid.plus(F.col(_LO), F.col(_AT)).alias(spec.time))


_AGGREGATES = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


def resample(
    df: DataFrame, spec: SeriesSpec, every: str, agg: str = "mean", dense: bool = True, keys: Sequence[str] | None = None
) -> DataFrame:
    """Target per calendar bucket of length ``every``, for each series or, with ``keys=()``, over all of them.

    With ``dense`` the buckets between the first and the last are all present: an empty one has sum and count 0, and no mean.
    """
    keys = tuple(spec.keys if keys is None else keys)
    step = Step.parse(every)
    rows = known_keys(df, keys).filter(F.col(spec.time).isNotNull())
    # group on the bucket number: a long is cheaper to hash than a rebuilt timestamp
    out = rows.groupBy(*keys, step.index(spec.time).alias(_K)).agg(_AGGREGATES[agg](spec.target).alias(spec.target))
    out = out.select(*keys, step.start(F.col(_K)).alias(spec.time), spec.target)
    if agg == "sum":
        # a bucket whose values are all null sums to 0, like an empty one
        out = out.withColumn(spec.target, F.coalesce(spec.target, F.lit(0.0)))
    if not dense:
        return out
    # measured on the rows: cheaper than on the buckets, which would be built twice
    out = densify(out, settle(rows, spec.with_(keys=keys, step=every, unique=True)))
    return out.fillna(0, subset=[spec.target]) if agg in ("sum", "count") else out
