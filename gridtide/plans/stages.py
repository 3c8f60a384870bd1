"""From raw observations to feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gridtide.operators.columns import drop_columns, target_first, with_measure
from gridtide.operators.continuity import discontinuous_series, drop_discontinuous
from gridtide.operators.features import make_features
from gridtide.operators.fill import forward_fill
from gridtide.operators.layout import known_keys, settle
from gridtide.operators.split import time_split
from gridtide.sources.readers import OBSERVATIONS, read_observations, read_table
from gridtide.sources.writers import write_splits
from gridtide.spec import BacktestSpec, FeatureSpec, SeriesSpec

#: the hourly energy panel: a unit's production and consumption are two series
ENERGY = SeriesSpec(keys=("prediction_unit_id", "is_consumption"))
FLAG, ROW_ID, BOOKKEEPING = "is_consumption", "row_id", ("data_block_id", "row_id")


def preprocess(
    df: DataFrame,
    spec: SeriesSpec = ENERGY,
    cutoff=BacktestSpec().cutoff,
    flag: str = FLAG,
    fill: str = "series",
    order: str | None = ROW_ID,
    boundary: str = "series",
) -> DataFrame:
    """Contiguous series with filled targets, target first, tagged with ``measure`` and ``split``.

    ``boundary="series"`` drops the series that miss a step; ``"frame"`` measures steps over the whole sorted table and drops a unit (the
    keys without the flag) with all its measures.

    ``fill="series"`` fills within a series; ``"frame"`` in file order within a measure, across series.
    """
    spec = settle(df, spec)
    rows = target_first(df, spec.target)
    if boundary == "frame":
        unit = [k for k in spec.keys if k != flag]
        broken = discontinuous_series(rows, spec, "frame").select(*unit).distinct()
        rows = known_keys(rows, spec.keys).join(broken, unit, "left_anti").select(*rows.columns)
    else:
        rows = drop_discontinuous(rows, spec)
    rows = with_measure(rows, flag)
    if fill == "frame":
        rows = forward_fill(rows, spec, [spec.target], scope="frame", order=order, partition=["measure"])
    else:
        rows = forward_fill(rows, spec, [spec.target])
    return time_split(rows, spec, cutoff)


def feature_table(
    df: DataFrame,
    spec: SeriesSpec = ENERGY,
    features: FeatureSpec = FeatureSpec(),
    drop: Sequence[str] = BOOKKEEPING,
    keep_test_head: bool = False,
) -> DataFrame:
    """Features of all measures and both sides of the split at once, without bookkeeping columns and time.

    Each side is a series of its own and loses its first rows; with ``keep_test_head`` the test rows look back into train.
    """
    rows = drop_columns(df, [c for c in drop if c in df.columns])
    spec = settle(rows, spec)
    if not keep_test_head:
        return make_features(rows, spec.with_(keys=(*spec.keys, "measure", "split")), features).drop(spec.time)
    inner = spec.with_(keys=(*spec.keys, "measure"))
    train = rows.filter("split = 'train'")
    made = make_features(train, inner, features).unionByName(
        make_features(rows.filter("split = 'test'"), inner, features, history=train)
    )
    return made.drop(spec.time)


def prepare_stages(
    spark: SparkSession,
    raw_path: str,
    preprocessed_path: str,
    processed_path: str,
    spec: SeriesSpec = ENERGY,
    features: FeatureSpec = FeatureSpec(),
    cutoff=BacktestSpec().cutoff,
    force: bool = False,
    schema: str = OBSERVATIONS,
    flag: str = FLAG,
    fill: str = "series",
    order: str | None = ROW_ID,
    boundary: str = "series",
    drop: Sequence[str] = BOOKKEEPING,
) -> DataFrame:
    """Raw CSV → preprocessed table → feature table, each skipped when it is already there. Returns the features.

    ``schema`` is that of the CSV files; ``flag``, ``fill``, ``order`` and ``boundary`` are as in :func:`preprocess`, ``drop`` as in :func:`feature_table`.
    """
    from gridtide.sources.writers import is_complete

    if force or not is_complete(spark, preprocessed_path):
        raw = read_observations(spark, raw_path, schema)
        write_splits(preprocess(raw, spec, cutoff, flag, fill, order, boundary), preprocessed_path)
    if force or not is_complete(spark, processed_path):
        write_splits(feature_table(read_table(spark, preprocessed_path), spec, features, drop), processed_path)
    return read_table(spark, processed_path)
