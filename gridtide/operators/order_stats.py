"""Exact order statistics without sorting a column and without holding its values in one task.

A position is narrowed down in counting passes: by order of magnitude, by place inside the chosen magnitude (again while
a place still holds many rows), and by value inside the chosen place. Each pass is a map-side combined count with a
bounded number of buckets, so a heavy group or a heavy value costs no more than any other. Passes end as soon as the
chosen buckets hold a single value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.operators.layout import as_local, collect_small
from gridtide.session import stage

#: buckets per unit of ln|x| in the first pass (0.1 % wide), and places per bucket in the passes after it
_PER_E, _PER_BUCKET = 1024, 1 << 16
#: rows of a place whose values are counted one by one
_FEW = 1 << 20
#: after this many passes by place, no place holds more than one double: 0.1 % of a magnitude has less than 2^(16·3)
_PLACES = 3

_V, _B1, _LO, _HI, _N, _AT = "_gt_v", "_gt_b1", "_gt_lo", "_gt_hi", "_gt_n", "_gt_at"
_WANTED, _ALL = "_gt_wanted", "_gt_all"


def _magnitude(v: Column) -> Column:
    """A non-decreasing whole number of ``v``: negatives, zero, positives, each by size."""
    size = F.floor(F.least(F.log(F.abs(v)), F.lit(1000.0)) * _PER_E) + 1_000_000
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0).cast("bigint"))


def _place(v: Column, lo: Column, hi: Column) -> Column:
    return F.floor((v - lo) / (hi - lo) * _PER_BUCKET)


def _counts(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(_N), F.min(_V).alias(_LO), F.max(_V).alias(_HI))


def _pick(counts: DataFrame, within: Sequence[str], bucket: str) -> DataFrame:
    """Buckets that hold a wanted position; positions become relative to their bucket."""
    w = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.col(_AT) - F.col(_N)
    here = F.filter(_WANTED, lambda t: (t["position"] >= before) & (t["position"] < F.col(_AT)))
    moved = F.transform(
        here, lambda t: F.struct(t["target"], (t["position"] - before).alias("position"), t["n"])
    )
    return counts.withColumn(_AT, F.sum(_N).over(w)).withColumn(_WANTED, moved).filter(F.size(_WANTED) > 0).drop(_AT)


def values_at(
    rows: DataFrame, group: Sequence[str], value: str, positions: Sequence[Callable[[Column], Column]]
) -> DataFrame:
    """Value at zero-based positions of the ascending order of ``value``, per group.

    ``rows``: (group…, value DOUBLE); nulls and NaN are ignored. A position is a function of the group's row count.
    Returns (group…, ``target``, ``value``, ``offset``, ``n``): the number of the position in the list, its value, how many
    equal values come before it, and the group's row count. A position outside the group gives no row. ``group`` must name
    at least one column, without nulls.
    """
    group = list(group)
    rows = rows.select(*group, F.col(value).alias(_V)).filter(F.col(_V).isNotNull() & ~F.isnan(_V))
    rows1 = rows.withColumn(_B1, _magnitude(F.col(_V)))
    counts1 = _counts(rows1, [*group, _B1]).withColumn(_ALL, F.sum(_N).over(Window.partitionBy(*group)))
    n = F.col(_ALL)
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("target"), p(n).cast("bigint").alias("position"), n.alias("n"))
            for i, p in enumerate(positions)
        ]
    )
    where, inside = [*group, _B1], rows1
    picked = _pick(counts1.withColumn(_WANTED, wanted).drop(_ALL), group, _B1)
    found = []
    for depth in range(_PLACES + 1):
        # either way the next pass reads it, and does not plan this one again
        local = collect_small(picked)
        picked = stage(picked, "places") if local is None else as_local(picked, local)
        found.append(_answers(picked.filter(F.col(_LO) == F.col(_HI)), group))
        if local is not None and local.column(_LO).equals(local.column(_HI)):
            break
        still = picked.filter(F.col(_LO) < F.col(_HI))
        done = depth == _PLACES or (local is not None and pc.max(local.column(_N)).as_py() <= _FEW)
        inside = inside.join(still.select(*where, _LO, _HI), where)
        bucket = _V if done else f"_gt_place{depth}"
        if not done:
            inside = inside.withColumn(bucket, _place(F.col(_V), F.col(_LO), F.col(_HI)))
        inside = inside.drop(_LO, _HI)
        counts = _counts(inside, [*where, bucket]).join(still.select(*where, _WANTED), where)
        picked, where = _pick(counts, where, bucket), [*where, bucket]
        if done:
            found.append(_answers(picked, group))
            break
    return reduce(DataFrame.unionByName, found)


def _answers(picked: DataFrame, group: Sequence[str]) -> DataFrame:
    """Positions that fell in a bucket of one value."""
    rows = picked.select(*group, F.col(_LO).alias("value"), F.explode(_WANTED).alias("t"))
    return rows.select(*group, "t.target", "value", F.col("t.position").alias("offset"), "t.n")


def is_float(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType))


def known(df: DataFrame, col: str) -> Column:
    """A column with NaN read as null."""
    x = F.col(f"`{col}`")
    return F.when(~F.isnan(x), x) if is_float(df, col) else x


def known_number(c: Column | str) -> Column:
    """A number as DOUBLE, with NaN read as null."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x), x)


def quantiles_wide(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation: (by…, ``column``, ``q0``, ``q1`` …), nulls ignored.

    A column (of a group) without values has no row.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), known_number(c).alias(_V)) for c in cols])
    # null groups are groups: a flag beside the value keeps them apart in joins
    flags = [F.col(c).isNull().alias(f"_gt_null_{i}") for i, c in enumerate(by)]
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_gt_key_{i}") for i, c in enumerate(by)]
    rows = df.select(*keys, *flags, F.inline(pairs))
    group = [c for c in rows.columns if c != _V]

    def end(p: float, up: bool) -> Callable[[Column], Column]:
        return lambda n: (F.ceil if up else F.floor)(F.lit(float(p)) * (n - 1))

    found = values_at(rows, group, _V, [end(p, up) for p in probs for up in (False, True)])
    at = [F.max(F.when(F.col("target") == i, F.col("value"))).alias(f"v{i}") for i in range(2 * len(probs))]
    wide = found.groupBy(*group, "n").agg(*at)
    out = []
    for i, p in enumerate(probs):
        lo, hi, place = F.col(f"v{2 * i}"), F.col(f"v{2 * i + 1}"), F.lit(float(p)) * (F.col("n") - 1)
        out.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (place - F.floor(place))).alias(f"q{i}"))
    back = [
        F.when(~F.col(f"_gt_null_{i}"), F.col(f"_gt_key_{i}")).cast(df.schema[c].dataType).alias(c)
        for i, c in enumerate(by)
    ]
    return wide.select(*back, "column", *out)


def quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """As :func:`quantiles_wide`, one row per quantile: (by…, ``column``, ``prob``, ``value``)."""
    wide = quantiles_wide(df, cols, probs, by)
    items = F.array(*[F.struct(F.lit(float(p)).alias("prob"), F.col(f"q{i}").alias("value")) for i, p in enumerate(probs)])
    return wide.select(*by, "column", F.inline(items))
