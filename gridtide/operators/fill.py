"""Repairing nulls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtide.operators.layout import bucket_of, by_range, depth_of, known_keys, once, range_of, running, settle
from gridtide.operators.order_stats import is_float, known
from gridtide.spec import SeriesSpec


def forward_fill(
    df: DataFrame,
    spec: SeriesSpec,
    cols: Sequence[str] | None = None,
    scope: str = "series",
    order: str | None = None,
    partition: Sequence[str] = (),
) -> DataFrame:
    """Replace nulls, and NaN, by the last known value before them. Leading nulls stay.

    ``scope="series"``: within the series, in time order.
    ``scope="frame"``: in the order of a whole-number column (``order``, e.g. the row number of a file) within ``partition``
    (e.g. the measure), across series. Rows are cut into even ranges of ``order``; only the last known value of each range
    travels between them, so no single task sees the whole table, however sparse the order is. Null orders come last.
    """
    if scope == "series":
        part, by = spec.keys, [spec.time]
        rows = known_keys(df, part)
        spec = settle(rows, spec)
        rows, bucket, depth = once(rows, spec), bucket_of(spec), depth_of(spec)
    elif scope == "frame":
        if order is None:
            raise ValueError("scope='frame' needs the order column")
        part, by = tuple(partition), [order]
        rows, bucket, depth = by_range(known_keys(df, part), by), range_of(), 1
    else:
        raise ValueError(f"unknown scope: {scope!r}")
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in (*part, *by, *spec.keys, spec.time)]
    rows = rows.withColumns({c: known(rows, c) for c in cols if is_float(rows, c)})
    filled = {c: f"_gt_fill_{c}" for c in cols}
    out = running(rows, part, by, {new: ("last", c) for c, new in filled.items()}, bucket, depth=depth)
    return out.select(*[F.col(filled[c]).alias(c) if c in filled else F.col(f"`{c}`") for c in df.columns])


def union_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys found in either table, once each."""
    return a.unionByName(b).distinct()


def update_from(base: DataFrame, patch: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Overwrite ``cols`` with the non-null values of ``patch`` (one row per key at most)."""
    renamed = patch.select(*on, *[F.col(c).alias(f"_gt_new_{c}") for c in cols])
    joined = base.join(renamed, list(on), "left")
    return joined.select(
        *[F.coalesce(f"_gt_new_{c}", c).alias(c) if c in set(cols) else F.col(f"`{c}`") for c in base.columns]
    )
