"""Projections, row filters and casts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridtide.operators.layout import by_range, local_table, range_of, running, small_copy
from gridtide.operators.order_stats import known


def target_first(df: DataFrame, target: str) -> DataFrame:
    return df.select(target, *[c for c in df.columns if c != target])


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.drop(*cols)


class ColumnDropper(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Pipeline stage that removes columns, e.g. identifiers a model must not see."""

    columns = Param(Params._dummy(), "columns", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return drop_columns(df, self.getOrDefault(self.columns))


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def split_measure(df: DataFrame, flag: str, value: int, drop: bool = True) -> DataFrame:
    """Rows of one measure."""
    rows = df.filter(F.col(flag) == value)
    return rows.drop(flag) if drop else rows


def with_measure(df: DataFrame, flag: str, names: Mapping[int, str] | None = None) -> DataFrame:
    """Keep both measures in one table, named in a ``measure`` column."""
    name = F.lit(None).cast("string")
    for value, label in (names or {0: "production", 1: "consumption"}).items():
        name = F.when(F.col(flag) == value, F.lit(label)).otherwise(name)
    return df.withColumn("measure", name)


def _key_table(df: DataFrame, ids: DataFrame | Iterable, key: str) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids
    schema = T.StructType([T.StructField(key, df.schema[key].dataType)])
    return local_table(df.sparkSession, {key: ids}, schema)


def keep_series(df: DataFrame, ids: DataFrame | Iterable, key: str | Sequence[str]) -> DataFrame:
    """Rows of the listed series; ``ids`` is a table of keys, or plain values for a single key."""
    on = [key] if isinstance(key, str) else list(key)
    return df.join(_key_table(df, ids, on[0]).select(*on), on, "left_semi")


def drop_series(df: DataFrame, ids: DataFrame | Iterable, key: str | Sequence[str]) -> DataFrame:
    """All rows but those of the listed series. Rows with a null key stay."""
    on = [key] if isinstance(key, str) else list(key)
    return df.join(_key_table(df, ids, on[0]).select(*on), on, "left_anti")


def time_between(df: DataFrame, time: str, lo, hi, **equals) -> DataFrame:
    """Rows with ``lo`` ≤ time ≤ ``hi`` and, optionally, given key values."""
    rows = df.filter(F.col(time).between(_instant(lo), _instant(hi)))
    for key, value in equals.items():
        rows = rows.filter(F.col(key) == value)
    return rows


def _instant(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def hour_of_day_between(df: DataFrame, time: str, lo: int, hi: int) -> DataFrame:
    """Rows with ``lo`` ≤ hour of day < ``hi``."""
    return df.filter((F.hour(time) >= lo) & (F.hour(time) < hi))


def null_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows whose value is null or NaN."""
    return df.filter(known(df, col).isNull())


def offset_column(df: DataFrame, col: str, eps: float, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, F.col(col) + F.lit(eps))


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(cols) if cols is not None else None)


def features_and_label(
    df: DataFrame, label: str, features: Sequence[str] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """(features vector, label), and the columns in ``keep``. Features default to every numeric column but the label."""
    cols = list(features) if features is not None else numeric_columns(df, exclude=(label, *keep))
    made = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep").transform(df)
    return made.select("features", F.col(label).cast("double").alias("label"), *keep)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


def parse_time(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    text = F.col(col)
    return df.withColumn(col, F.to_timestamp_ntz(text, F.lit(fmt)) if fmt else F.to_timestamp_ntz(text))


def downcast_ints(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Narrow whole-number columns to the smallest type that holds the unsigned 8/16/32-bit range they fit.

    Spark has no unsigned types: 8 bits → SMALLINT, 16 → INT, 32 → BIGINT. A column with negative values, one
    without values, and one whose type is as narrow already stay as they are.
    """
    cols = list(cols) if cols is not None else [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    if not cols:
        return df
    row = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    limits = ((2**8 - 1, "smallint"), (2**16 - 1, "int"))
    width = {"tinyint": 1, "smallint": 2, "int": 4, "bigint": 8}
    casts = {}
    for c in cols:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        if lo is None or lo < 0:
            continue
        kind = next((t for top, t in limits if hi <= top), "bigint")
        if width[kind] < width[df.schema[c].dataType.simpleString()]:
            casts[c] = F.col(c).cast(kind)
    return df.withColumns(casts)


def downcast_floats(df: DataFrame, cols: Sequence[str] | None = None, tolerance: float = 5e-4) -> DataFrame:
    """Narrow DOUBLE columns to FLOAT where every value moves by at most ``tolerance``."""
    cols = list(cols) if cols is not None else [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    if not cols:
        return df

    def lost(c: str) -> Column:
        x, y = F.col(c), F.col(c).cast("float").cast("double")
        return F.count_if((x != y) & ~(F.abs(x - y) <= tolerance))

    row = df.agg(*[lost(c).alias(c) for c in cols]).first()
    return df.withColumns({c: F.col(c).cast("float") for c in cols if row[c] == 0})


def as_category(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Add the position of each value among the sorted distinct values (``-1`` for null)."""
    values = df.select(col).filter(F.col(col).isNotNull()).distinct()
    values = by_range(values.withColumn("_gt_one", F.lit(1)), [col])
    codes = running(values, (), [col], {"_gt_code": ("sum", "_gt_one")}, range_of(), depth=1)
    codes = small_copy(codes.select(col, (F.col("_gt_code") - 1).cast("int").alias("_gt_code")))
    return (
        df.join(codes, col, "left")
        .withColumn(out or f"{col}_code", F.coalesce("_gt_code", F.lit(-1)))
        .drop("_gt_code")
        .select(*df.columns, out or f"{col}_code")
    )


def categories(df: DataFrame, col: str) -> DataFrame:
    """The sorted dictionary of a category column."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def as_bool(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.col(col).cast("boolean"))
