"""Histograms and kernel densities as tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.operators.layout import by_range, range_of, running, small_copy
from gridtide.operators.order_stats import quantiles

_X, _BIN = "_gt_x", "bin"
#: bins of a density to a bandwidth, and the highest power that is summed in each
_PER_BANDWIDTH, _POWERS = 64, 8
#: bins that are listed one by one
MOST_BINS = 1 << 16
#: beyond this many bandwidths the Gaussian kernel is zero in double precision: exp(-z²/2) underflows
_KERNEL_REACH = 39.0


def category_histogram(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def _measured(df: DataFrame, col: str, log: bool) -> DataFrame:
    x = F.col(col).cast("double")
    return df.withColumn(_X, F.when(x > 0, F.log10(x)) if log else x).filter(
        F.col(_X).isNotNull() & ~F.isnan(_X) & ~F.abs(_X).isin(float("inf"))
    )


def dropped_by_log(df: DataFrame, col: str) -> DataFrame:
    """How many known values a logarithmic axis cannot show."""
    return df.agg(F.count_if(F.col(col) <= 0).alias("dropped"))


def auto_bins(n: int, lo: float, hi: float, iqr: float, whole: bool = False) -> int:
    """Bin count of the 'auto' rule: the narrower of Freedman–Diaconis and Sturges, Sturges if the IQR is 0.

    Whole numbers get no bin narrower than 1.
    """
    if hi == lo:
        return 1
    width = (hi - lo) / (math.log2(n) + 1.0)
    if iqr > 0:
        width = min(width, 2.0 * iqr * n ** (-1.0 / 3.0))
    if whole and width < 1:
        width = 1.0
    return max(1, math.ceil((hi - lo) / width))


def bin_edges(df: DataFrame, col: str, bins: int | str = "auto", log: bool = False) -> tuple[float, float, int] | None:
    """(first edge, last edge, number of bins) of a column; None if it has no value to bin."""
    x = _measured(df, col, log)
    row = x.agg(F.count(_X).alias("n"), F.min(_X).alias("lo"), F.max(_X).alias("hi")).first()
    n, lo, hi = row["n"], row["lo"], row["hi"]
    if not n:
        return None
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
        return lo, hi, (1 if bins == "auto" else int(bins))
    if bins != "auto":
        return lo, hi, int(bins)
    q = {r["prob"]: r["value"] for r in quantiles(x, [_X], [0.25, 0.75]).collect()}
    whole = not log and isinstance(df.schema[col].dataType, T.IntegralType)
    return lo, hi, auto_bins(n, lo, hi, q[0.75] - q[0.25], whole)


def histogram(
    df: DataFrame, col: str, bins: int | str = "auto", log: bool = False, by: str | None = None
) -> DataFrame:
    """Rows per equal-width bin: (by), ``bin``, ``left``, ``right``, ``count``. The last bin is closed.

    All bins appear, if there are at most ``MOST_BINS``. Of more, as an outlier makes of a rule for their width, those with rows appear, and each run of
    empty ones between as one row, from the first's left to the last's right edge.

    ``log`` bins log10 of the values and leaves out those ≤ 0 (see :func:`dropped_by_log`). With ``by`` every group uses the
    edges of the whole column.
    """
    group = [by] if by else []
    edges = bin_edges(df, col, bins, log)
    if edges is None:
        out = df.select(*group).limit(0)
        for name, kind in ((_BIN, "bigint"), ("left", "double"), ("right", "double"), ("count", "bigint")):
            out = out.withColumn(name, F.lit(None).cast(kind))
        return out
    lo, hi, n = edges
    width = (hi - lo) / n

    def edge(i: Column) -> Column:
        return F.when(i == n, F.lit(hi)).otherwise(i * F.lit(width) + F.lit(lo))

    x = F.col(_X)
    # the quotient may round across an edge: the edges decide
    guess = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(n - 1).cast("bigint"))
    placed = _measured(df, col, log).select(*group, _X, guess.alias(_BIN))
    b = F.col(_BIN)
    fixed = F.when((b > 0) & (x < edge(b)), b - 1).when((b < n - 1) & (x >= edge(b + 1)), b + 1).otherwise(b)
    counts = placed.select(*group, fixed.alias(_BIN)).groupBy(*group, _BIN).agg(F.count(F.lit(1)).alias("count"))
    if n > MOST_BINS:
        return _with_empty_runs(counts, group, n, edge)
    if by:
        counts = small_copy(counts)
        # a group's empty bins: one row per group, spread over the bins
        frame = counts.select(by).distinct().withColumn(_BIN, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))))
        full = frame.alias("f").join(
            counts.alias("c"), F.col(f"f.{by}").eqNullSafe(F.col(f"c.{by}")) & (F.col("f.bin") == F.col("c.bin")), "left"
        ).select(F.col(f"f.{by}").alias(by), F.col("f.bin").alias(_BIN), F.col("c.count").alias("count"))
    else:
        full = df.sparkSession.range(n).withColumnRenamed("id", _BIN).join(counts, _BIN, "left")
    return full.select(
        *group, _BIN, edge(F.col(_BIN)).alias("left"), edge(F.col(_BIN) + 1).alias("right"),
        F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
    )


def _with_empty_runs(counts: DataFrame, group: list[str], n: int, edge: Callable[[Column], Column]) -> DataFrame:
    """Bins with rows, and a row for each run of bins without, between, before and after them."""
    b, prev = F.col(_BIN), F.coalesce("_gt_prev", F.lit(-1))
    # bins are cut into ranges, so the one before is found without one task for all
    ordered = by_range(counts.withColumn("_gt_before", b), [*group, _BIN])
    ordered = running(ordered, group, [_BIN], {"_gt_prev": ("last", "_gt_before")}, range_of(), inclusive=False, depth=1)
    cols = [*group, _BIN, edge(b).alias("left"), edge(b + 1).alias("right"), "count"]
    none = F.lit(0).cast("bigint").alias("count")

    def empty(first: Column, end: Column) -> list:
        return [*group, first.alias(_BIN), edge(first).alias("left"), edge(end).alias("right"), none]

    gaps = ordered.filter(b > prev + 1).select(*empty(prev + 1, b))
    ends = counts.groupBy(*group).agg(F.max(b).alias(_BIN)).filter(b < n - 1).select(*empty(b + 1, F.lit(n).cast("bigint")))
    return ordered.select(*cols).unionByName(gaps).unionByName(ends)


def _hermite_series(z: Column) -> Column:
    """Sum over k of ``m{k} He_k(z) / k!``, as a polynomial of z."""
    # coefficients of He_k by He_k+1 = z He_k - k He_k-1
    he = [[1.0], [0.0, 1.0]]
    for k in range(1, _POWERS):
        he.append([(he[k][j - 1] if j else 0.0) - (k * he[k - 1][j] if j < k else 0.0) for j in range(k + 2)])
    out = F.lit(0.0)
    for j in range(_POWERS, -1, -1):
        terms = [(k, he[k][j] / math.factorial(k)) for k in range(j, _POWERS + 1) if he[k][j]]
        out = out * z + reduce(lambda a, b: a + b, [F.col(f"m{k}") * F.lit(c) for k, c in terms])
    return out


def kde(
    df: DataFrame, col: str, by: str | None = None, log: bool = False, grid: int = 200, cut: float = 3.0
) -> DataFrame:
    """Gaussian kernel density on ``grid`` points: (by), ``point``, ``x``, ``density``.

    Bandwidth is Scott's rule per group; a group's grid runs ``cut`` bandwidths past its values and its curve is scaled by its
    share of the rows. Groups without spread have no density.

    Rows add to bins a 64th of a bandwidth wide: their number, and the sums of the powers up to the eighth of their distance from the bin's
    middle, combined before the shuffle. Bins, not rows, meet the grid points that the kernel reaches (beyond them it is zero in double precision),
    with the kernel as its Hermite series around the bin's middle. With a distance of t and z bandwidths from the point the series leaves out about
    ``(z t) ** 9 / 9!`` of the kernel: with t up to 1/128 less than 1e-10 of it out to where it is zero, and less than 1e-20 next to the point.
    """
    group = [by] if by else []
    x = _measured(df, col, log).select(*group, _X)
    if by:
        x = x.filter(F.col(by).isNotNull())
    stats = small_copy(
        x.groupBy(*group).agg(F.count(_X).alias("n"), F.stddev_samp(_X).alias("std"), F.min(_X).alias("lo"), F.max(_X).alias("hi"))
    )
    total = stats.agg(F.sum("n").alias("n")).first()["n"] or 0
    stats = stats.filter("std > 0")
    stats = stats.withColumn("h", F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    stats = stats.withColumn("g0", F.col("lo") - cut * F.col("h")).withColumn(
        "dx", (F.col("hi") + cut * F.col("h") - F.col("g0")) / (grid - 1)
    )
    stats = stats.select(*group, "h", "g0", "dx")
    if by:
        points = x.join(stats, by)
    else:
        row = stats.first()
        if row is None:
            points = x.limit(0).withColumns({c: F.lit(0.0) for c in ("h", "g0", "dx")})
        else:
            points = x.withColumns({c: F.lit(row[c]) for c in ("h", "g0", "dx")})
    size = F.col("h") / _PER_BANDWIDTH
    points = points.withColumn("b", F.floor((F.col(_X) - F.col("g0")) / size))
    points = points.withColumn("t", (F.col(_X) - F.col("g0") - (F.col("b") + 0.5) * size) / F.col("h"))
    powers, power = [F.count(F.lit(1)).cast("double").alias("m0")], F.lit(1.0)
    for k in range(1, _POWERS + 1):
        power = power * F.col("t")
        powers.append(F.sum(power).alias(f"m{k}"))
    bins = points.groupBy(*group, "b").agg(*powers, *[F.first(c).alias(c) for c in ("h", "g0", "dx")])
    middle = (F.col("b") + 0.5) * F.col("h") / _PER_BANDWIDTH
    place, reach = middle / F.col("dx"), _KERNEL_REACH * F.col("h") / F.col("dx")
    first = F.greatest(F.ceil(place - reach), F.lit(0).cast("bigint"))
    last = F.least(F.floor(place + reach), F.lit(grid - 1).cast("bigint"))
    spread = bins.filter(first <= last).withColumn("point", F.explode(F.sequence(first, last)))
    spread = spread.withColumn("z", (F.col("point") * F.col("dx") - middle) / F.col("h"))
    z = F.col("z")
    mass = spread.groupBy(*group, "point").agg(F.sum(_hermite_series(z) * F.exp(-0.5 * z * z)).alias("mass"))
    # grid points far from every value have density zero but are still part of the curve
    if by:
        curve = stats.withColumn("point", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(grid - 1).cast("bigint"))))
        curve = curve.join(mass, [by, "point"], "left")
    else:
        curve = df.sparkSession.range(grid).withColumnRenamed("id", "point").join(mass, "point", "left")
        curve = curve.withColumns({c: F.lit(row[c]) for c in ("h", "g0", "dx")}) if row is not None else curve.limit(0).withColumns({c: F.lit(0.0) for c in ("h", "g0", "dx")})
    scale = F.lit(float(total) * math.sqrt(2.0 * np.pi)) * F.col("h")
    return curve.select(
        *group, "point", (F.col("g0") + F.col("point") * F.col("dx")).alias("x"),
        (F.coalesce("mass", F.lit(0.0)) / scale).alias("density"),
    )
