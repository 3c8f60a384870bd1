"""Steps between rows, and series that miss one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.functions.steps import micros
from gridtide.operators.layout import bucket_of, by_range, cut, depth_of, known_keys, once, range_of, running, series_stats, settle
from gridtide.spec import SeriesSpec

_STEPS = "_gt_steps"


def time_steps(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add ``prev_time`` and ``step`` (time minus the previous time of the series)."""
    rows = known_keys(df, spec.keys)
    spec = settle(rows, spec)
    previous = {"prev_time": ("last", spec.time)}
    out = running(once(rows, spec), spec.keys, [spec.time], previous, bucket_of(spec), inclusive=False, depth=depth_of(spec))
    return out.withColumn("step", F.col(spec.time) - F.col("prev_time"))


def _in_steps(spec: SeriesSpec, earlier: Column, later: Column) -> Column:
    """Distance in steps: whole months on a calendar grid, an exact ratio otherwise."""
    grid = spec.grid
    if grid.is_calendar:
        return (grid.index(later) - grid.index(earlier)).cast("double")
    return (micros(later) - micros(earlier)) / grid.length


def discontinuous_series(df: DataFrame, spec: SeriesSpec, boundary: str = "series") -> DataFrame:
    """Series whose longest step (``max_steps``, in steps) is not exactly one.

    ``boundary="series"``: a series' first row has no step, so a one-row series is listed with a null.
    ``boundary="frame"``: the first step of a series is taken from the last row of the series before it in key order, as
    a shift over the whole sorted table would do.
    """
    if boundary not in ("series", "frame"):
        raise ValueError(f"unknown boundary: {boundary!r}")
    steps = time_steps(df.select(*spec.keys, spec.time), spec)
    out = steps.groupBy(*spec.keys).agg(
        F.max(_in_steps(spec, F.col("prev_time"), F.col(spec.time))).alias("max_steps"),
        F.min(spec.time).alias("lo"),
        F.max(spec.time).alias("hi"),
    )
    if boundary == "frame":
        # over one row per series
        out = running(by_range(out, spec.keys), (), spec.keys, {"before": ("last", "hi")}, range_of(), inclusive=False, depth=1)
        out = out.withColumn("max_steps", F.greatest("max_steps", _in_steps(spec, F.col("before"), F.col("lo"))))
    return out.filter(~F.col("max_steps").eqNullSafe(F.lit(1.0))).select(*spec.keys, "max_steps")


def drop_discontinuous(df: DataFrame, spec: SeriesSpec, boundary: str = "series") -> DataFrame:
    """Rows of the series without a gap."""
    if boundary == "frame":
        return known_keys(df, spec.keys).join(discontinuous_series(df, spec, boundary), list(spec.keys), "left_anti")
    spec = settle(known_keys(df, spec.keys), spec)
    steps = time_steps(cut(once(df, spec), spec), spec)
    steps = steps.withColumn(_STEPS, _in_steps(spec, F.col("prev_time"), F.col(spec.time)))
    flagged = series_stats(steps, spec, {"_gt_max": ("max", _STEPS)})
    return flagged.filter(F.col("_gt_max") == 1.0).select(*df.columns)
