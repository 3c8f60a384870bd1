"""Sorting, top rows, sampling of series, and row sets."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.operators.layout import in_order, known_keys
from gridtide.operators.split import key_text
from gridtide.spec import SeriesSpec


def sort_by(df: DataFrame, cols: Sequence[str], ascending: bool = True) -> DataFrame:
    """Sort; nulls come last in either direction."""
    return df.orderBy(*(in_order(*cols) if ascending else [F.col(c).desc_nulls_last() for c in cols]))


def top_k(df: DataFrame, col: str, k: int, asc: bool = True, ties: Sequence[str] = ()) -> DataFrame:
    """First ``k`` rows in the order of ``col``; each task keeps ``k`` rows."""
    return sort_by(df, [col], asc).limit(k) if not ties else df.orderBy(
        F.col(col).asc_nulls_last() if asc else F.col(col).desc_nulls_last(), *in_order(*ties)
    ).limit(k)


def best_row(df: DataFrame, metric: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the smallest known metric."""
    return top_k(df.filter(F.col(metric).isNotNull()), metric, 1, ties=ties)


def sample_series(df: DataFrame, spec: SeriesSpec, k: int, seed: int = 42) -> DataFrame:
    """``k`` different series, the same ones for the same seed however the table is partitioned."""
    keys = known_keys(df, spec.keys).select(*spec.keys).distinct()
    return keys.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), key_text(spec.keys))), *spec.keys).limit(k)


def stack_rows(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def align_columns(frames: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Frames side by side, matched on key columns that are unique in each; a key missing in a frame gives nulls there."""
    return reduce(lambda a, b: a.join(b, list(on), "full_outer"), frames)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(cols)) if cols else df.distinct()


def different_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (with multiplicity) that only one of two tables has; ``n`` is positive for the first, negative for the second.

    Both sides are counted before the rows meet, so equal rows travel once.
    """
    cols = a.columns
    both = a.withColumn("_gt_side", F.lit(1)).unionByName(b.withColumn("_gt_side", F.lit(-1)))
    return both.groupBy(*cols).agg(F.sum("_gt_side").alias("n")).filter("n <> 0")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: ``same`` is true if both tables hold the same rows equally often (nulls are equal)."""
    return different_rows(a, b).agg((F.count(F.lit(1)) == 0).alias("same"))
