"""Splits along time."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridtide.functions.steps import micros
from gridtide.operators.columns import _instant
from gridtide.operators.layout import local_table, small_copy
from gridtide.operators.order_stats import values_at
from gridtide.spec import SeriesSpec

_ALL, _M, _DIGEST = "_gt_group", "_gt_micros", "_gt_digest"
#: a null time sorts last
_NEVER = float("inf")


def time_split(df: DataFrame, spec: SeriesSpec, cutoff) -> DataFrame:
    """Add ``split``: train up to and including the cutoff, test after it; null for a null time."""
    t = F.col(spec.time)
    at = _instant(cutoff)
    return df.withColumn("split", F.when(t <= at, "train").when(t > at, "test"))


def check_split(df: DataFrame, split: str = "split") -> DataFrame:
    """One row: total, train and test rows, and whether nothing is left over."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(split) == "train").alias("n_train"),
        F.count_if(F.col(split) == "test").alias("n_test"),
    )
    return counts.withColumn("complete", F.col("n_rows") == F.col("n_train") + F.col("n_test"))


def _micros_at(df: DataFrame, time: str, positions: Sequence[Callable[[Column], Column]]) -> tuple[DataFrame, int]:
    """(``target``, ``value``, ``offset``): time, in microseconds, of the rows at given positions in time order; and the time they count from.

    A double holds microseconds exactly over 285 years, so they are counted from the first time.
    """
    first = df.agg(F.min(micros(time))).first()[0] or 0
    at = F.coalesce((micros(time) - F.lit(first)).cast("double"), F.lit(_NEVER))
    rows = df.select(F.lit(0).alias(_ALL), at.alias(_M))
    return values_at(rows, [_ALL], _M, positions), first


def _from_micros(m, first: int):
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.expr("interval '0.000001' second") * (m.cast("bigint") + F.lit(first))


def cutoff_at_fraction(df: DataFrame, spec: SeriesSpec, fraction: float = 0.80) -> DataFrame:
    """One row, ``cutoff``: time of the row at zero-based position int(n · fraction) in time order. Null times come last.

    Found by counting (see ``order_stats``); no row is sorted.
    """
    if not 0 <= fraction < 1:
        raise ValueError(f"fraction must be in [0, 1): {fraction}")
    found, first = _micros_at(df, spec.time, [lambda n: F.floor(n * F.lit(float(fraction)))])
    return found.select(F.when(F.col("value") < _NEVER, _from_micros(F.col("value"), first)).alias("cutoff"))


def key_text(cols: Sequence[str]) -> Column:
    """Keys as text, different for different keys."""
    if len(cols) == 1:
        return F.coalesce(F.col(cols[0]).cast("string"), F.lit(""))
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def _digest(cols: Sequence[str], row: Sequence[str]) -> Column:
    """Order of rows with equal time: a hash of the keys, so that it is spread evenly whatever the keys are; then one of the whole row."""
    return F.concat(F.md5(key_text(cols)), F.md5(F.to_json(F.struct(*row))))


def expanding_folds(
    df: DataFrame, spec: SeriesSpec, k: int = 5, by: str = "row", ties: Sequence[str] | None = None
) -> DataFrame:
    """Add ``block`` (0 … k): fold i trains on ``block < i`` and validates on ``block = i``.

    With n rows each validation block holds m = n // (k+1) rows, the last one ending at the last row; block 0 has the rest.
    Order is time, then the digest of ``ties`` (default: the series keys), then that of the row; of rows that are alike in all columns, any
    may come first.
    ``by="time"`` keeps the rows of one time in one block: a boundary moves back to the first row of its time.

    Only the k boundary rows are looked for, by counting; the rows themselves get their block by comparing with them, without
    a shuffle. Rows with a null time have no block.
    """
    if by not in ("row", "time"):
        raise ValueError(f"unknown by: {by!r}")
    ties = list(ties if ties is not None else spec.keys)
    timed = df.filter(F.col(spec.time).isNotNull())

    def start(i: int) -> Callable[[Column], Column]:
        return lambda n: n - (k + 1 - i) * F.call_function("div", n, F.lit(k + 1))

    # a position of n (no row) means that there are fewer than k + 1 rows
    found, zero = _micros_at(timed, spec.time, [start(i) for i in range(1, k + 1)])
    bound = {r["target"] + 1: r for r in found.collect()}
    if len(bound) < k:
        raise ValueError(f"too few rows for {k} folds")
    at_time = {i: zero + int(r["value"]) for i, r in bound.items()}

    t, digest = F.col(spec.time), _digest(ties, df.columns)
    at = {i: _instant(_instant_of(m)) for i, m in at_time.items()}
    if by == "time":
        passed = [F.when(t >= at[i], 1).otherwise(0) for i in at]
    else:
        found = _boundary_digests(timed, spec, ties, {i: (at_time[i], r["offset"]) for i, r in bound.items()})
        first, alike = {i: d for i, (d, _) in found.items()}, {i: n for i, (_, n) in found.items() if n}
        # the digest is a branch of its own: it is computed for the rows at a boundary time only
        passed = {i: F.when(t > at[i], 1).when(t == at[i], (digest >= F.lit(first[i])).cast("int")).otherwise(0) for i in at}
        if alike:  # a boundary between rows that are alike: these are numbered
            is_alike = reduce(lambda a, b: a | b, [(t == at[i]) & (digest == F.lit(first[i])) for i in alike])
            is_alike = F.coalesce(is_alike, F.lit(False))
            number = F.row_number().over(Window.partitionBy(t, digest).orderBy(F.lit(1)))
            later = {i: F.when((t == at[i]) & (digest == F.lit(first[i])), (number > n).cast("int")).otherwise(passed[i]) for i, n in alike.items()}
            rest = df.filter(~is_alike).withColumn("block", F.when(t.isNotNull(), sum(passed.values(), F.lit(0))))
            return rest.unionByName(df.filter(is_alike).withColumn("block", sum((passed | later).values(), F.lit(0))))
        passed = list(passed.values())
    return df.withColumn("block", F.when(t.isNotNull(), sum(passed, F.lit(0))))


def _boundary_digests(
    df: DataFrame, spec: SeriesSpec, ties: Sequence[str], bound: dict[int, tuple[int, int]]
) -> dict[int, tuple[str, int]]:
    """Digest of each boundary row, given its time and its place among the rows that share this time; and the rows alike before it."""
    times = sorted({m for m, _ in bound.values()})
    tied = df.filter(F.col(spec.time).isin([_instant(_instant_of(m)) for m in times]))
    tied = tied.select(micros(spec.time).alias(_M), _digest(ties, df.columns).alias(_DIGEST))
    # two levels: count by the first digits of the digest, then order the rows of the one prefix that is hit
    tied = tied.withColumn("prefix", F.substring(_DIGEST, 1, 4))
    w = Window.partitionBy(_M).orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = tied.groupBy(_M, "prefix").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(w))
    spark = df.sparkSession
    folds, m, at = zip(*[(i, m, at) for i, (m, at) in bound.items()], strict=True)
    wanted = local_table(spark, {"fold": folds, _M: m, "position": at}, f"fold int, {_M} bigint, position bigint")
    hit = counts.join(wanted, _M).filter("position < upto AND position >= upto - n")
    hits = small_copy(hit.select("fold", _M, "prefix", (F.col("position") - F.col("upto") + F.col("n")).alias("place")))
    inside = tied.join(hits.select(_M, "prefix").distinct(), [_M, "prefix"])
    w = Window.partitionBy(_M, "prefix").orderBy(_DIGEST)
    inside = inside.withColumns({"place": F.row_number().over(w).cast("bigint") - 1, "first": F.rank().over(w).cast("bigint") - 1})
    found = inside.join(hits, [_M, "prefix", "place"])
    return {r["fold"]: (r[_DIGEST], r["n"]) for r in found.select("fold", _DIGEST, (F.col("place") - F.col("first")).alias("n")).collect()}


def _instant_of(m: int) -> datetime:
    return datetime(1970, 1, 1) + timedelta(microseconds=m)
