"""Running and rolling values from mergeable states.

A :class:`Monoid` says what the state of a stretch of rows is, how the states of two neighbouring stretches merge, and which value a state has. Nothing
else is needed to carry a running value from piece to piece of a series (:func:`scanned`), or to slide a window over it in the same time for each row
however long it is (:func:`blocked`, :func:`rolled`): a window that ends in a block of as many rows is the end of the block before and the
beginning of this one, and both are running values.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridtide.session import stage

#: pieces whose states are merged together at each level
FAN = 1024
#: a window up to this size is read anew for each row, which is cheaper than sorting blocks
SMALL_WINDOW = 64
_PIECE, _OFF, _LEVEL = "_gt_scan_piece", "_gt_scan_off", "_gt_scan_level"
#: how far weights may grow within a piece of an exponentially weighted mean
_GROWTH = 1e60


@dataclass(frozen=True)
class Monoid:
    """``over(value, frame, place)`` is the state of the rows of a frame, ``place`` counting rows from the start of a piece; ``merge(earlier, later)``
    must be associative; ``most`` bounds the rows of a piece."""

    over: Callable[[Column, WindowSpec, Column], Column]
    merge: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column]
    most: int | None = None


def _n(x: Column, w: WindowSpec) -> Column:
    return F.count(x).over(w).alias("n")


def _mean() -> Monoid:
    return Monoid(
        lambda x, w, _: F.struct(_n(x, w), F.coalesce(F.sum(x.cast("double")).over(w), F.lit(0.0)).alias("s")),
        lambda a, b: F.struct((a.n + b.n).alias("n"), (a.s + b.s).alias("s")),
        lambda s: s.s / F.nullif(s.n, F.lit(0)),
    )


def _moments(finish: Callable[[Column], Column]) -> Monoid:
    """Number, mean and sum of squared deviations, which merge without cancellation."""

    def over(x, w, _):
        x = x.cast("double")
        n = F.count(x).over(w)
        return F.struct(
            n.alias("n"), F.coalesce(F.avg(x).over(w), F.lit(0.0)).alias("m"), F.coalesce(F.var_pop(x).over(w) * n, F.lit(0.0)).alias("q")
        )

    def merge(a, b):
        n = a.n + b.n
        share, apart = b.n / F.nullif(n, F.lit(0)), b.m - a.m
        return F.struct(
            n.alias("n"),
            (a.m + F.coalesce(apart * share, F.lit(0.0))).alias("m"),
            (a.q + b.q + F.coalesce(apart * apart * a.n * share, F.lit(0.0))).alias("q"),
        )

    return Monoid(over, merge, finish)


def _extreme(of: Callable, pick: Callable) -> Monoid:
    return Monoid(
        lambda x, w, _: F.struct(_n(x, w), of(x).over(w).alias("v")),
        lambda a, b: F.struct((a.n + b.n).alias("n"), pick(a.v, b.v).alias("v")),
        lambda s: s.v,
    )


def ewm_mean(alpha: float) -> Monoid:
    """``y = alpha * x + (1 - alpha) * y before``, the first row's y being its x; rows without a value are not expected.

    A row is the map ``y -> a y + b``, and maps compose. Within a piece b is a sum of values whose weights grow by ``1 / (1 - alpha)`` with each row,
    scaled back; pieces end before that loses anything.
    """
    keep = 1.0 - alpha
    most = 1 if keep <= 0 else max(1, min(1 << 16, int(math.log(_GROWTH) / -math.log(keep))))

    def over(x, w, place):
        # the first row of a series has no row before it
        weight = F.when(F.col(FIRST), F.lit(1.0)).otherwise(F.lit(alpha)) * F.pow(F.lit(keep), -place)
        return F.struct(F.pow(F.lit(keep), place + 1).alias("a"), (F.pow(F.lit(keep), place) * F.sum(x * weight).over(w)).alias("b"))

    return Monoid(
        over, lambda a, b: F.struct((a.a * b.a).alias("a"), (b.a * a.b + b.b).alias("b")), lambda s: s.b, most
    )


#: marks the first row of a series while :func:`scanned` works
FIRST = "_gt_scan_first"
MONOIDS: dict[str, Monoid] = {
    "mean": _mean(),
    "std": _moments(lambda s: F.sqrt(s.q / F.nullif(s.n - 1, F.lit(0)))),
    "min": _extreme(F.min, F.least),
    "max": _extreme(F.max, F.greatest),
}


def _rows(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _carried(table: DataFrame, part: Sequence[str], piece: str, monoids: Mapping[str, Monoid], depth: int) -> DataFrame:
    """(part, piece, state of all pieces before) from a written table of (part, piece, state).

    ``FAN`` pieces are merged with one another by doubling: after step k a piece holds the state of the 2^k up to it. What a group of pieces
    starts from is the same again on the table of groups.
    """
    group = F.floor(F.col(piece) / FAN) if depth > 1 else F.lit(0)
    w = Window.partitionBy(*part, _LEVEL).orderBy(piece)
    rows = table.withColumn(_LEVEL, group)
    step = 1
    # the last level has all groups that there are: their number is looked up
    upto = FAN if depth > 1 else (table.groupBy(*part).count().agg(F.max("count")).first()[0] or 1)
    while step < upto:
        rows = rows.withColumns({f"{n}_before": F.lag(n, step).over(w) for n in monoids})
        merged = {n: F.when(F.col(f"{n}_before").isNull(), F.col(n)).otherwise(m.merge(F.col(f"{n}_before"), F.col(n))) for n, m in monoids.items()}
        rows = rows.withColumns(merged).drop(*[f"{n}_before" for n in monoids])
        step *= 2
    inside = rows.withColumns({f"{n}_before": F.lag(n).over(w) for n in monoids})
    if depth == 1:
        return inside.select(*part, piece, *[F.col(f"{n}_before").alias(n) for n in monoids])
    inside = stage(inside, "scan-pieces")
    groups = inside.groupBy(*part, _LEVEL).agg(*[F.max_by(n, piece).alias(n) for n in monoids])
    above = f"{piece}_{depth}"
    outer = _carried(stage(groups.withColumnRenamed(_LEVEL, above), "scan-groups"), part, above, monoids, depth - 1)
    outer = outer.select(*part, F.col(above).alias(_LEVEL), *[F.col(n).alias(f"{n}_outer") for n in monoids])
    joined = inside.join(outer, [*part, _LEVEL], "left")

    def both(name, monoid):
        before, outer_state = F.col(f"{name}_before"), F.col(f"{name}_outer")
        return F.when(outer_state.isNull(), before).when(before.isNull(), outer_state).otherwise(monoid.merge(outer_state, before))

    return joined.select(*part, piece, *[both(n, m).alias(n) for n, m in monoids.items()])


def scanned(
    df: DataFrame, part: Sequence[str], pos: str, values: Mapping[str, tuple[Monoid, str]], size: int | None, depth: int = 2
) -> DataFrame:
    """Add running values ``{new: (monoid, source)}`` along ``pos``, which numbers the rows of each part from 1.

    Without ``size`` a part is one window partition, unless a monoid bounds its pieces. With it, or then, parts are cut into pieces of that many rows:
    states within pieces by built-in windows, carries between them from the small table of pieces, which is written. ``df`` is read twice
    and should be a written table.
    """
    bounds = [b for b in [size, *[m.most for m, _ in values.values()]] if b is not None]
    if not bounds:
        w = _rows(Window.partitionBy(*part).orderBy(pos))
        states = df.withColumns({n: m.over(F.col(c), w, F.col(pos) - 1) for n, (m, c) in values.items()})
        return states.withColumns({n: m.finish(F.col(n)) for n, (m, _) in values.items()})
    most = min(bounds)
    place = F.col(pos) - 1
    rows = df.withColumns({_PIECE: F.floor(place / most), _OFF: F.pmod(place, F.lit(most)), FIRST: F.col(pos) == 1})
    w = _rows(Window.partitionBy(*part, _PIECE).orderBy(pos))
    rows = rows.withColumns({n: m.over(F.col(c), w, F.col(_OFF)) for n, (m, c) in values.items()})
    table = rows.groupBy(*part, _PIECE).agg(*[F.max_by(n, pos).alias(n) for n in values])
    monoids = {n: m for n, (m, _) in values.items()}
    before = _carried(stage(table, "scan-table"), part, _PIECE, monoids, depth)
    joined = rows.join(before.select(*part, _PIECE, *[F.col(n).alias(f"{n}_carry") for n in values]), [*part, _PIECE], "left")

    def value(name, monoid):
        carry, here = F.col(f"{name}_carry"), F.col(name)
        return F.when(carry.isNull(), monoid.finish(here)).otherwise(monoid.finish(monoid.merge(carry, here)))

    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *[value(n, m).alias(n) for n, m in monoids.items()])


def blocked(df: DataFrame, part: Sequence[str], pos: str, windows: Mapping[str, tuple[Monoid, str, int]]) -> DataFrame:
    """Add, for each window ``{name: (monoid, source, size)}``, the states from the start of a row's block up to it and from it to the block's end."""
    for name, (monoid, source, size) in windows.items():
        block = f"_gt_block_{size}"
        if block not in df.columns:
            df = df.withColumn(block, F.floor((F.col(pos) - 1) / size))
        up = _rows(Window.partitionBy(*part, block).orderBy(pos))
        down = _rows(Window.partitionBy(*part, block).orderBy(F.col(pos).desc()))
        df = df.withColumns({f"{name}_up": monoid.over(F.col(source), up, F.lit(0)), f"{name}_down": monoid.over(F.col(source), down, F.lit(0))})
    return df


def block_columns(windows: Mapping[str, tuple[Monoid, str, int]]) -> list[str]:
    """The columns that :func:`blocked` adds."""
    return [f"_gt_block_{size}" for size in {s for _, _, s in windows.values()}] + [f"{n}_{way}" for n in windows for way in ("up", "down")]


def rolled(w: WindowSpec, pos: str, name: str, monoid: Monoid, lag: int, size: int) -> Column:
    """The value over ``size`` rows that end ``lag`` rows back, from the states of :func:`blocked`; null until all of them have one."""
    up, down = F.lag(f"{name}_up", lag).over(w), F.lag(f"{name}_down", lag + size - 1).over(w)
    state = F.when(F.pmod(F.col(pos) - lag, F.lit(size)) == 0, up).otherwise(F.when(down.isNotNull(), monoid.merge(down, up)))
    return F.when(state.n == size, monoid.finish(state))


def framed(w: WindowSpec, source: str, monoid: Monoid, lag: int, size: int) -> Column:
    """The same from the rows themselves: right for small windows."""
    frame = w.rowsBetween(-(lag + size - 1), -lag)
    return F.when(F.count(F.col(source)).over(frame) == size, monoid.finish(monoid.over(F.col(source), frame, F.lit(0))))
