"""Results that must not depend on layout, partitioning or the future; and comparisons with numpy and pandas."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridtide.operators.autocorr import acf, levinson_durbin
from gridtide.operators.calendar import densify, resample
from gridtide.operators.continuity import discontinuous_series, drop_discontinuous, time_steps
from gridtide.operators.distribution import histogram
from gridtide.operators.features import make_features, series_tail
from gridtide.operators.fill import forward_fill
from gridtide.operators.layout import small_copy
from gridtide.operators.ordering import different_rows
from gridtide.operators.order_stats import quantiles, values_at
from gridtide.operators.profile import describe_columns
from gridtide.operators.split import cutoff_at_fraction, expanding_folds
from gridtide.spec import FeatureSpec, SeriesSpec

T0 = datetime(2024, 1, 1)
SCHEMA = "id int, datetime timestamp_ntz, target double"


def random_panel(spark, seed, nulls=False, gaps=True):
    rng = random.Random(seed)
    rows = []
    for k in range(rng.randint(2, 5)):
        t = rng.randint(0, 50)
        for _ in range(rng.choice([1, 3, 40, 90])):
            rows.append((k, T0 + timedelta(hours=t), None if nulls and rng.random() < 0.4 else float(rng.randint(0, 99))))
            t += rng.choice([1, 1, 1, 2, 9, 60]) if gaps else 1
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(rng.randint(1, 5)).persist()


def equal(a, b):
    digits = [F.round(F.col(c) + 1e-10, 8).alias(c) if t == "double" else F.col(c) for c, t in a.dtypes]
    assert a.columns == b.columns
    return different_rows(a.select(*digits), b.select(*digits)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_layouts_agree(spark, seed):
    spec = SeriesSpec(("id",), layout="whole")
    cut = spec.with_(layout="chunked", chunk_rows=random.Random(seed).choice([1, 2, 7, 30]))
    df, holes = random_panel(spark, seed), random_panel(spark, seed + 100, nulls=True)
    fs = FeatureSpec((1, 5), (2,), (1, 4))
    for op in (
        lambda s: make_features(df, s, fs, dropna=False),
        lambda s: densify(holes, s),
        lambda s: forward_fill(holes, s),
        lambda s: time_steps(df, s),
        lambda s: discontinuous_series(df, s),
        lambda s: drop_discontinuous(df, s),
        lambda s: acf(df, s, 6, adjusted=True),
    ):
        assert equal(op(spec), op(cut))


def test_features_ignore_the_future_and_the_partitioning(spark):
    df = random_panel(spark, 7, gaps=False)
    spec, fs = SeriesSpec(("id",), layout="whole"), FeatureSpec((3, 5), (2,), (1, 4), True, ())
    at = T0 + timedelta(hours=60)
    a = make_features(df, spec, fs, dropna=False)
    changed = df.withColumn("target", F.when(F.col("datetime") >= at, F.lit(-1e6)).otherwise(F.col("target")))
    b = make_features(changed, spec, fs, dropna=False)
    until = F.col("datetime") <= at + timedelta(hours=1)  # the shortest lag is 2
    assert equal(a.filter(until).drop("target"), b.filter(until).drop("target"))
    assert equal(a, make_features(df.repartition(7, "target"), spec, fs, dropna=False))


@pytest.mark.parametrize(
    "values",
    [
        [0.0, -0.0, 1.0, -1.0, 1e300, -1e300, 5e-324, -5e-324, float("inf"), float("-inf")],
        [1.0000000001, 1.0000000002, 1.0000000003, 1.0],
        [3.0] * 50 + [4.0],
        list(np.random.default_rng(1).lognormal(0, 8, 400)),
        list(np.random.default_rng(2).normal(0, 1, 401).round(1)),
        list(1e9 + np.random.default_rng(3).random(300)),
        [42.0],
    ],
)
def test_order_statistics(spark, values):
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("a", None), ("a", float("nan"))], "g string, x double")
    want = sorted(float(v) for v in values)
    n = len(want)
    places = sorted({0, 1 % n, n // 3, n // 2, n - 1})
    got = values_at(df, ["g"], "x", [lambda _, p=p: F.lit(p) for p in places] + [lambda n: n]).collect()
    assert [r.value for r in sorted(got, key=lambda r: r.target)] == [want[p] for p in places]
    assert all(want.index(r.value) + r.offset == places[r.target] and r.n == n for r in got)
    if np.isfinite(want).all():
        q = quantiles(df, ["x"], [0.0, 0.1, 0.5, 0.75, 1.0]).orderBy("prob").collect()
        assert [r.value for r in q] == pytest.approx(list(np.quantile(want, [0.0, 0.1, 0.5, 0.75, 1.0])), rel=1e-12)


def test_order_statistics_when_groups_do_not_fit_a_local_table(spark, monkeypatch):
    from gridtide.operators import order_stats

    monkeypatch.setattr(order_stats, "collect_small", lambda df: None)
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 6, 500), "x": rng.lognormal(0, 2, 500)})
    got = quantiles(spark.createDataFrame(pdf), ["x"], [0.25, 0.9], by=["g"]).collect()
    want = pdf.groupby("g").x.quantile([0.25, 0.9])
    assert len(got) == 12
    assert all(r.value == pytest.approx(want[r.g, r.prob]) for r in got)


def test_describe_against_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 300), "x": rng.normal(0, 50, 300), "y": rng.integers(-5, 9, 300)})
    pdf.loc[::7, "x"] = np.nan
    df = spark.createDataFrame(pdf.astype({"g": object}))
    got = describe_columns(df, ["x", "y"]).toPandas().set_index("column")
    want = pdf[["x", "y"]].describe().T
    assert np.allclose(got[["count", "mean", "std", "min", "p25", "p50", "p75", "max"]].astype(float), want)
    by = describe_columns(df, ["x"], by=["g"]).toPandas()
    want = pdf.groupby("g", dropna=False).x.median()
    assert {r.g if isinstance(r.g, str) else None: pytest.approx(r.p50) for r in by.itertuples()} == {
        k if isinstance(k, str) else None: v for k, v in want.items()
    }


@pytest.mark.parametrize("seed", range(2))
def test_histogram_against_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.gamma(2.0, 30.0, 700).round(2) if seed else rng.normal(0, 1, 500)
    got = histogram(spark.createDataFrame(pd.DataFrame({"x": x})), "x").orderBy("bin").toPandas()
    edges = np.histogram_bin_edges(x, "auto")
    assert np.allclose([*got.left, got.right.iloc[-1]], edges)
    assert list(got["count"]) == list(np.histogram(x, edges)[0])


def test_resample_against_pandas(spark):
    df = random_panel(spark, 11, nulls=True)
    pdf = df.toPandas()
    for every, rule in (("1 day", "D"), ("6 hour", "6h")):
        for agg in ("sum", "mean", "count"):
            got = resample(df, SeriesSpec(("id",)), every, agg).toPandas().set_index(["id", "datetime"]).target.sort_index()
            want = pdf.set_index("datetime").groupby("id").target.resample(rule).agg(agg)
            assert list(got.index) == list(want.index)
            assert np.allclose(got.astype(float), want.astype(float), equal_nan=True)


def test_cutoffs_and_folds_of_random_times(spark):
    df = random_panel(spark, 3, gaps=False)
    times = sorted(r.datetime for r in df.collect())
    spec = SeriesSpec(("id",))
    for f in (0.0, 0.33, 0.8, 0.99):
        assert cutoff_at_fraction(df, spec, f).first().cutoff == times[int(len(times) * f)]
    m = len(times) // 5
    folds = expanding_folds(df, spec, 4)
    sizes = {r.block: r["count"] for r in folds.groupBy("block").count().collect()}
    assert sizes == {0: len(times) - 4 * m, 1: m, 2: m, 3: m, 4: m}
    ends = [(r.lo, r.hi) for r in folds.groupBy("block").agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi")).orderBy("block").collect()]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))
    with pytest.raises(ValueError, match="too few rows"):
        expanding_folds(df.limit(3), spec, 4)


def test_partial_autocorrelation_solves_yule_walker():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3, 200)).cumsum(axis=1)
    x -= x.mean(axis=1, keepdims=True)
    r = np.stack([(x[:, : 200 - k] * x[:, k:]).sum(1) for k in range(8)], axis=1)
    r /= r[:, :1]
    got = levinson_durbin(r)
    for row in range(3):
        for k in range(1, 8):
            toeplitz = np.array([[r[row, abs(i - j)] for j in range(k)] for i in range(k)])
            assert got[row, k] == pytest.approx(np.linalg.solve(toeplitz, r[row, 1 : k + 1])[-1])


def test_tail_and_small_copy(spark):
    df = random_panel(spark, 1)
    tail = series_tail(df, SeriesSpec(("id",)), 2).toPandas()
    want = df.toPandas().sort_values("datetime").groupby("id").tail(2)
    assert sorted(map(tuple, tail.values)) == sorted(map(tuple, want.values))
    assert small_copy(df, 5) is df
    assert "LocalTableScan" in small_copy(df)._jdf.queryExecution().executedPlan().toString()
