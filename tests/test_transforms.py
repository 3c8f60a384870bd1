"""Lag transforms: the same values as pandas in both layouts, whatever the pieces, blocks and levels."""

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridtide import FeatureSpec, LagTransform, SeriesSpec
from gridtide.operators import features, scans

SPEC = SeriesSpec(("id",), time="t", target="y", step="1 hour")
KINDS = [
    LagTransform("expanding_mean", 2), LagTransform("expanding_std", 1), LagTransform("expanding_min", 3), LagTransform("expanding_max", 1),
    LagTransform("rolling_mean", 1, 5), LagTransform("rolling_std", 2, 7), LagTransform("rolling_min", 1, 7), LagTransform("rolling_max", 4, 3),
    LagTransform("rolling_std", 1, 1), LagTransform("rolling_mean", 3, 30),
]
WEIGHTED = [LagTransform("exponentially_weighted_mean", lag, alpha=a) for lag, a in ((1, 0.3), (2, 0.05), (1, 0.999), (3, 1.0))]


@pytest.fixture(scope="module")
def panel(spark):
    rng, start = random.Random(4), datetime(2024, 1, 1)
    rows = [(s, start + timedelta(hours=i), rng.gauss(1e6, 3)) for s, n in (("a", 143), ("b", 1), ("c", 12), ("d", 70)) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "id string, t timestamp_ntz, y double").cache()


def expected(frame, transforms):
    out = []
    for _, rows in frame.sort_values(["id", "t"]).groupby("id"):
        rows = rows.copy()
        for t in transforms:
            y = rows["y"]
            if t.alpha is not None:
                made = y.ewm(alpha=t.alpha, adjust=False).mean()
            else:
                over = y.rolling(t.window) if t.window else y.expanding()
                made = getattr(over, t.statistic)()
            rows[t.name] = made.shift(t.lag)
        out.append(rows)
    return pd.concat(out).reset_index(drop=True)


def result(df):
    return df.toPandas().sort_values(["id", "t"]).reset_index(drop=True)


@pytest.mark.parametrize("spec", [SPEC.with_(layout="whole"), SPEC.with_(layout="chunked", chunk_rows=8), SPEC.with_(layout="chunked", chunk_rows=64)])
@pytest.mark.parametrize("small", [2, 64])
def test_equal_to_pandas(panel, spec, small, monkeypatch):
    monkeypatch.setattr(features, "SMALL_WINDOW", small)
    monkeypatch.setattr(scans, "FAN", 4)
    # weights of 0.3 grow by 1e3 in 19 rows: pieces of the weighted mean end early
    monkeypatch.setattr(scans, "_GROWTH", 1e3)
    transforms = KINDS + WEIGHTED
    got = result(features.add_transforms(panel, spec, transforms))
    pd.testing.assert_frame_equal(got, expected(panel.toPandas(), transforms), check_exact=False, rtol=1e-12, atol=1e-7)


def test_nulls_in_windows_and_nan(panel):
    holed = panel.withColumn("y", F.when(F.hour("t") == 5, None).when(F.hour("t") == 9, float("nan")).otherwise(F.col("y")))
    plain = [t for t in KINDS if t.kind != "expanding_std"]
    want = expected(holed.toPandas(), plain)
    for spec in (SPEC.with_(layout="whole"), SPEC.with_(layout="chunked", chunk_rows=8)):
        got = result(features.add_transforms(holed, spec, plain))
        names = [t.name for t in plain if t.window]
        pd.testing.assert_frame_equal(got[names], want[names], check_exact=False, rtol=1e-12, atol=1e-7)
        with pytest.raises(PySparkException, match="null target"):
            features.add_transforms(holed, spec, WEIGHTED[:1]).collect()


def test_in_a_feature_table(panel):
    spec = FeatureSpec((1,), (2,), (3,), True, (), (*KINDS[1:3], WEIGHTED[0], LagTransform("rolling_mean", 2, 3)))
    assert FeatureSpec.from_json(spec.to_json()) == spec
    assert features.feature_names(spec) == [
        "lag1", "expanding_mean_lag2", "rolling_mean_lag2_window_size3", "expanding_std_lag1", "expanding_min_lag3",
        "exponentially_weighted_mean_lag1_alpha0_3",
    ]
    for layout_ in ("whole", "chunked"):
        made = features.make_features(panel, SPEC.with_(layout=layout_, chunk_rows=16), spec)
        assert made.columns == [*panel.columns, *features.feature_names(spec)]
        # the window of three rows that ends two rows back needs most
        want = expected(panel.toPandas(), spec.transforms)
        want = want[want.groupby("id").cumcount() >= 4].reset_index(drop=True)
        names = ["id", "t", *[t.name for t in spec.transforms]]
        pd.testing.assert_frame_equal(result(made)[names], want[names], check_exact=False, rtol=1e-12, atol=1e-7)


def test_last_pieces_without_rows_before(panel):
    """A window longer than the series gives nulls; one as long as a block, too, is right at every place."""
    t = [LagTransform("rolling_max", 1, 100), LagTransform("rolling_mean", 1, 65)]
    for spec in (SPEC.with_(layout="whole"), SPEC.with_(layout="chunked", chunk_rows=4)):
        got = result(features.add_transforms(panel, spec, t))
        pd.testing.assert_frame_equal(got, expected(panel.toPandas(), t), check_exact=False, rtol=1e-12)


@pytest.mark.parametrize(
    "bad", [("median", 1), ("rolling_mean", 1), ("expanding_mean", 1, 3), ("rolling_std", 0, 3), ("exponentially_weighted_mean", 1, None, 1.5)]
)
def test_refused(bad):
    with pytest.raises(ValueError):
        LagTransform(*bad)
