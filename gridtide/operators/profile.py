"""Profiles of a table: shape, nulls, distinct values, extents, summary statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtide.operators.columns import numeric_columns
from gridtide.operators.layout import known_keys
from gridtide.operators.order_stats import known, known_number, quantiles_wide
from gridtide.spec import SeriesSpec


def _unpivot(one_row: DataFrame, cols: Sequence[str], *parts: str) -> DataFrame:
    """One row with columns ``{part}_{i}`` to one row per column of ``cols``."""
    items = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{p}_{i}").alias(p) for p in parts]) for i, c in enumerate(cols)
    ]
    return one_row.select(F.inline(F.array(*items)))


def shape_and_schema(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-null count; and the table's row and column counts."""
    cols = df.columns
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count(f"`{c}`").alias(f"n_{i}") for i, c in enumerate(cols)]
    )
    items = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"n_{i}").alias("non_null"),
            F.col("n_rows"),
            F.lit(len(cols)).alias("n_columns"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counts.select(F.inline(F.array(*items)))


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and ratio per column, in one pass. NaN counts as null."""
    cols = list(cols or df.columns)
    total = F.count(F.lit(1))
    nulls = [F.count_if(known(df, c).isNull()) for c in cols]
    one = df.agg(
        *[n.alias(f"nulls_{i}") for i, n in enumerate(nulls)],
        *[(n / F.nullif(total, F.lit(0))).alias(f"ratio_{i}") for i, n in enumerate(nulls)],
    )
    return _unpivot(one, cols, "nulls", "ratio")


def nulls_per_series(df: DataFrame, spec: SeriesSpec, min_count: int = 0) -> DataFrame:
    """Null targets per series, most first; series with more than ``min_count`` only."""
    out = known_keys(df, spec.keys).groupBy(*spec.keys).agg(F.count_if(known(df, spec.target).isNull()).alias("nulls"))
    return out.filter(F.col("nulls") > min_count).orderBy(F.desc("nulls"), *spec.keys)


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column. ``approx`` needs no shuffle of the values."""
    cols = list(cols or df.columns)
    if approx:
        return _unpivot(df.agg(*[F.approx_count_distinct(c).alias(f"n_{i}") for i, c in enumerate(cols)]), cols, "n")
    return _unpivot(df.agg(*[F.count_distinct(c).alias(f"n_{i}") for i, c in enumerate(cols)]), cols, "n")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def time_extent(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    lo, hi = F.min(spec.time), F.max(spec.time)
    return df.agg(lo.alias("start"), hi.alias("end")).withColumn("duration", F.col("end") - F.col("start"))


def series_extents(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    rows = known_keys(df, spec.keys)
    return rows.groupBy(*spec.keys).agg(F.min(spec.time).alias("start"), F.max(spec.time).alias("end"))


def unique_date_ranges(df: DataFrame, spec: SeriesSpec, sort: str = "start") -> DataFrame:
    """Distinct (start, end) pairs of the series, sorted by ``start`` or by ``end``."""
    other = {"start": "end", "end": "start"}[sort]
    return series_extents(df, spec).select("start", "end").distinct().orderBy(sort, other)


def describe_columns(
    df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Per column (and group): count, mean, sample std, min, exact quartiles, max. Nulls are ignored."""
    cols = list(cols) if cols is not None else numeric_columns(df, exclude=by)
    by = list(by)
    parts = ("count", "mean", "std", "min", "max")
    aggs = []
    for i, c in enumerate(cols):
        x = known_number(c)
        made = (F.count(x), F.avg(x), F.stddev_samp(x), F.min(x), F.max(x))
        aggs += [a.alias(f"{p}_{i}") for p, a in zip(parts, made, strict=True)]
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    items = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{p}_{i}").alias(p) for p in parts]) for i, c in enumerate(cols)
    ]
    moments = wide.select(*by, F.inline(F.array(*items)))
    names = {0.25: "p25", 0.5: "p50", 0.75: "p75"}
    quartiles = quantiles_wide(df, cols, list(names), by)
    # null-safe on the group: a null group is a group here
    on = [moments[c].eqNullSafe(quartiles[c]) for c in [*by, "column"]]
    joined = moments.join(quartiles, on, "left")
    quartile = [F.col(f"q{i}").alias(name) for i, name in enumerate(names.values())]
    return joined.select(*[moments[c] for c in by], moments["column"], *parts[:4], *quartile, "max")


def split_fractions(df: DataFrame, split: str = "split") -> DataFrame:
    """Rows and share of all rows for each side of a split."""
    counts = df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))  # a handful of labels
    return counts.withColumn("fraction", F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy()))
