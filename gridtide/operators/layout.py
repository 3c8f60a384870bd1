"""How ordered work over a series is spread over tasks.

``running`` is the building block for everything that looks back without limit (running counts and sums, last known
value); ``over_series`` for everything that looks back a fixed number of rows (lags, rolling windows).
Both give the same rows whether a series is one task or thousands.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.functions.steps import micros
from gridtide.operators.scans import Monoid, block_columns, blocked, scanned
from gridtide.session import stage
from gridtide.spec import SeriesSpec

_BUCKET = "_gt_bucket"
_CARRY = "_gt_carry_"
#: the number of a row in its series, from 1, while :func:`over_series` works
POS = "_gt_pos"
_BLOCK = "_gt_block"
_HOME = "_gt_home"
_START, _PREV = Window.unboundedPreceding, -1

#: buckets summarised together at each level of a running computation
FAN = 1024
#: the piece of rows without a time, after all others
_LAST = 1 << 52


def known_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that belong to a series: a row with a null key is in none."""
    return df.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)) if keys else df


def settle(df: DataFrame, spec: SeriesSpec) -> SeriesSpec:
    """Replace layout ``auto`` by the layout that fits this table (one aggregate over keys and time at most)."""
    if spec.layout != "auto":
        return spec
    if spec.unique:
        # months between the first and the last year a timestamp can hold
        if spec.grid.is_calendar and spec.whole_limit >= 12 * 9999:
            return spec.with_(layout="whole")
        ends = df.agg(F.min(spec.time).alias("lo"), F.max(spec.time).alias("hi"))
        span = ends.select((spec.grid.between(F.col("lo"), F.col("hi")) + 1).alias("span")).first()["span"]
        if (span or 0) <= spec.whole_limit:
            return spec.with_(layout="whole")
    per_series = df.groupBy(*spec.keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(spec.time).alias("lo"), F.max(spec.time).alias("hi")
    )
    span = spec.grid.between(F.col("lo"), F.col("hi")) + 1
    # the span bounds a series after its gaps are filled
    row = per_series.agg(F.max(F.greatest("n", span)).alias("longest"), F.max(F.col("n") > span).alias("crowded")).first()
    if (row["longest"] or 0) <= spec.whole_limit:
        return spec.with_(layout="whole")
    if not row["crowded"]:
        return spec.with_(layout="chunked")
    # more rows than steps: pieces as long as the busiest step allows
    per_step = df.groupBy(*spec.keys, spec.grid.index(spec.time)).count()
    busiest = per_step.agg(F.max("count")).first()[0]
    return spec.with_(layout="chunked", chunk_micros=max(1, spec.grid.about * spec.chunk_rows // busiest))


def chunk_of(spec: SeriesSpec) -> Column:
    """Piece of the time axis a row falls in: about ``chunk_rows`` rows of a series at most. A null time is in the last piece."""
    if spec.chunk_micros is not None:
        m = micros(spec.time)
        piece = F.call_function("div", m - F.pmod(m, F.lit(spec.chunk_micros)), F.lit(spec.chunk_micros))
    else:
        piece = F.floor(spec.grid.index(spec.time) / spec.chunk_rows)
    return F.coalesce(piece, F.lit(_LAST))


def cut(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Add the piece of each row as a column that consecutive steps on the same pieces share, and so shuffle once."""
    return df if spec.layout == "whole" or _BUCKET in df.columns else df.withColumn(_BUCKET, chunk_of(spec))


def bucket_of(spec: SeriesSpec) -> Column | None:
    """The piece as the ``bucket`` of :func:`running`; None in the whole layout."""
    return None if spec.layout == "whole" else chunk_of(spec)


def depth_of(spec: SeriesSpec) -> int:
    """Levels of pieces: a regular series has one piece per ``chunk_rows`` rows, a short list; an uneven one may have many more."""
    return 1 if spec.chunk_micros is None else 2


def once(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows as the chunked layout wants them: it reads its input twice, so rows that took a shuffle to make are written first.

    A chain of operators then grows by a constant for each of them. Tables that are merely read and filtered stay as they are.
    """
    if spec.layout != "chunked":
        return df
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = set(re.findall(r"^[\s:+-]*([A-Z]\w+)", plan, re.MULTILINE))
    return df if nodes <= {"Project", "Filter", "Relation", "LocalRelation", "Union", "Range"} else stage(df, "rows")


def by_range(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows in even ranges of ``order`` (sampled, so whatever the values look like), with the range as the piece of :func:`running`.

    Written first: sampling again must not give other ranges. Use ``depth=1``: there is one range for each shuffle partition.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(parts, *in_order(*order)).withColumn(_BUCKET, F.spark_partition_id().cast("bigint"))
    return stage(ranges, "ranges")


def range_of() -> Column:
    """The piece that :func:`by_range` added."""
    return F.col(_BUCKET)


def in_order(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


_COMBINE = {
    # how: (aggregate of a bucket, windowed function, join of the carry with the local result)
    "last": (
        lambda c, order: F.max_by(c, F.when(c.isNotNull(), order)),
        lambda c: F.last(c, ignorenulls=True),
        lambda here, before: F.coalesce(here, before),
    ),
    "sum": (
        lambda c, order: F.sum(c),
        F.sum,
        lambda here, before: F.when(here.isNull() & before.isNull(), None).otherwise(
            F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0))
        ),
    ),
}


def running(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, tuple[str, str]],
    bucket: Column | None = None,
    inclusive: bool = True,
    depth: int = 2,
) -> DataFrame:
    """Add running columns: ``{new: ("last" | "sum", source)}`` in ``order`` within ``part``.

    Without ``bucket`` each part is one window partition. With it (a non-decreasing whole number along the order; the
    column of :func:`cut` if it is there), rows are spread over (part, bucket); what earlier buckets contribute is found on the table of buckets,
    itself bucketed again ``depth - 1`` times, so neither a huge part nor an empty ``part`` ends in one task. That table is written, so
    the plan holds the rows once.
    """
    end = 0 if inclusive else _PREV
    if bucket is None:
        w = Window.partitionBy(*part).orderBy(*in_order(*order)).rowsBetween(_START, end)
        return df.withColumns({new: _COMBINE[how][1](F.col(c)).over(w) for new, (how, c) in values.items()})

    pieces = df if _BUCKET in df.columns else df.withColumn(_BUCKET, bucket)
    rank = F.struct(*order) if len(order) > 1 else F.col(order[0])
    table = pieces.groupBy(*part, _BUCKET).agg(
        *[_COMBINE[how][0](F.col(c), rank).alias(_CARRY + new) for new, (how, c) in values.items()]
    )
    level = f"{_BUCKET}_{depth}"
    table = stage(table.withColumnRenamed(_BUCKET, level), "pieces")
    before = running(
        table,
        part,
        [level],
        {f"{_CARRY}{new}_before": (how, _CARRY + new) for new, (how, _) in values.items()},
        bucket=F.floor(F.col(level) / FAN) if depth > 1 else None,
        inclusive=False,
        depth=depth - 1,
    ).select(*part, F.col(level).alias(_BUCKET), *[f"{_CARRY}{new}_before" for new in values])

    w = Window.partitionBy(*part, _BUCKET).orderBy(*in_order(*order)).rowsBetween(_START, end)
    joined = pieces.join(before, [*part, _BUCKET], "left")
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[
            _COMBINE[how][2](_COMBINE[how][1](F.col(c)).over(w), F.col(f"{_CARRY}{new}_before")).alias(new)
            for new, (how, c) in values.items()
        ],
    )


def series_stats(df: DataFrame, spec: SeriesSpec, stats: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add per-series figures to every row: ``{new: ("sum" | "count" | "min" | "max", source)}``.

    ``spec.layout`` must be settled. A chunked series gets them through its table of chunks, so no join is keyed on the
    series alone.
    """
    fn = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    w = Window.partitionBy(*spec.keys)
    if spec.layout == "whole":
        return df.withColumns({new: fn[how](F.col(c)).over(w) for new, (how, c) in stats.items()})
    merge = {**fn, "count": F.sum}
    pieces = cut(df, spec)
    table = pieces.groupBy(*spec.keys, _BUCKET).agg(*[fn[how](c).alias(new) for new, (how, c) in stats.items()])
    table = stage(table, "pieces").withColumns({new: merge[how](F.col(new)).over(w) for new, (how, _) in stats.items()})
    return pieces.join(table, [*spec.keys, _BUCKET]).select(*[F.col(f"`{c}`") for c in df.columns], *stats)


def over_series(
    df: DataFrame,
    spec: SeriesSpec,
    reach: int,
    build: Callable[[Window, Mapping[str, str] | None], Mapping[str, Column]],
    totals: Mapping[str, tuple[str, str]] | None = None,
    scans: Mapping[str, tuple[Monoid, str]] | None = None,
    windows: Mapping[str, tuple[Monoid, str, int]] | None = None,
) -> DataFrame:
    """Add the columns of ``build(window, totals)``; the window shows each row the ``reach`` rows before it.

    ``spec.layout`` must be settled. ``totals`` are running columns (see :func:`running`) that ``build`` may read in a
    chunked layout, where the window does not reach back to the start of the series; in the whole layout
    ``build`` gets ``None`` and uses an unbounded frame. ``scans`` are running values that ``build`` reads under their names in both layouts
    (see :func:`~gridtide.operators.scans.scanned`), and ``windows`` states for :func:`~gridtide.operators.scans.rolled`, next to the number
    :data:`POS` of each row.

    Chunked: rows are numbered along their series, cut into blocks by that number, and the last ``reach`` rows of a
    block are also sent to the next one. Every block is then complete on its own.
    """
    order, scans, windows = in_order(spec.time), dict(scans or {}), dict(windows or {})
    helpers = [*scans, *block_columns(windows)]
    if spec.layout == "whole":
        w = Window.partitionBy(*spec.keys).orderBy(*order)
        if not helpers:
            return df.withColumns(dict(build(w, None)))
        rows = df.withColumn(POS, F.row_number().over(w).cast("bigint"))
        if any(m.most for m, _ in scans.values()):
            rows = stage(rows, "rows")
        rows = blocked(scanned(rows, spec.keys, POS, scans, None) if scans else rows, spec.keys, POS, windows)
        return rows.withColumns(dict(build(Window.partitionBy(*spec.keys).orderBy(POS), None))).drop(POS, *helpers)

    df, totals = once(df, spec), dict(totals or {})
    names = {new: f"_gt_total_{new}" for new in totals}
    one = "_gt_one"
    numbered = running(
        df.withColumn(one, F.lit(1).cast("bigint")),
        spec.keys,
        [spec.time],
        {POS: ("sum", one), **{names[new]: how_col for new, how_col in totals.items()}},
        bucket=chunk_of(spec),
        depth=depth_of(spec),
    ).drop(one, _BUCKET)
    if scans:
        numbered = scanned(stage(numbered, "rows"), spec.keys, POS, scans, spec.chunk_rows)
    size = max(spec.chunk_rows, reach, 1)
    pos = F.col(POS) - 1
    home = F.floor(pos / size)
    tail = F.pmod(pos, F.lit(size)) >= size - reach
    spread = numbered.withColumn(_HOME, home).withColumn(
        _BLOCK, F.explode(F.when(tail, F.array(home, home + 1)).otherwise(F.array(home)))
    )
    spread = blocked(spread, [*spec.keys, _BLOCK], POS, windows)
    w = Window.partitionBy(*spec.keys, _BLOCK).orderBy(POS)
    made = spread.withColumns(dict(build(w, names))).filter(F.col(_BLOCK) == F.col(_HOME))
    return made.drop(POS, _BLOCK, _HOME, *names.values(), *helpers)


def collect_small(df: DataFrame, limit: int = 100_000) -> pa.Table | None:
    """The rows of a table of at most ``limit`` rows, else None."""
    rows = df.limit(limit + 1).toArrow()
    return rows if rows.num_rows <= limit else None


def as_local(df: DataFrame, rows: pa.Table) -> DataFrame:
    """Collected rows of ``df`` as a local relation: its size is known, so the optimizer may broadcast it."""
    return df.sparkSession.createDataFrame(rows, df.schema)


def small_copy(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """A table of at most ``limit`` rows as a local relation; a larger one unchanged, so that joins with it shuffle."""
    rows = collect_small(df, limit)
    return df if rows is None else as_local(df, rows)


def local_table(spark: SparkSession, columns: Mapping[str, Sequence], schema: str | T.StructType) -> DataFrame:
    """A few values as a local relation (a list of rows would become an RDD of unknown size)."""
    return spark.createDataFrame(pa.table({c: list(v) for c, v in columns.items()}), schema)
