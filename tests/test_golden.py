"""Small cases with known results."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridtide.functions.dates import add_date_features, utc_stamp
from gridtide.operators.autocorr import acf, pacf, top_lags
from gridtide.operators.calendar import densify, duplicate_times, missing_times, resample
from gridtide.operators.columns import downcast_floats, downcast_ints, drop_series, keep_series
from gridtide.operators.continuity import discontinuous_series, drop_discontinuous
from gridtide.operators.distribution import dropped_by_log, histogram, kde
from gridtide.operators.features import add_expanding_mean, add_lags, add_rolling_mean, make_features
from gridtide.operators.fill import forward_fill
from gridtide.operators.profile import describe_columns
from gridtide.operators.split import cutoff_at_fraction, expanding_folds
from gridtide.spec import BacktestSpec, FeatureSpec, SeriesSpec

T0 = datetime(2024, 1, 1)
LAYOUTS = ["whole", "chunked"]


def hours(*hs):
    return [T0 + timedelta(hours=h) for h in hs]


def panel(spark, series, layout="whole", chunk_rows=3):
    rows = [(k, t, None if v is None else float(v)) for k, points in series.items() for t, v in points]
    df = spark.createDataFrame(rows, "id int, datetime timestamp_ntz, target double").repartition(3)
    return df, SeriesSpec(keys=("id",), layout=layout, chunk_rows=chunk_rows)


@pytest.mark.parametrize("layout", LAYOUTS)
def test_fill_scope(spark, layout):
    rows = [(0, 0, 10.0), (1, 1, 20.0), (2, 0, None), (3, 1, 21.0), (4, 0, 12.0), (5, 1, None)]
    df = spark.createDataFrame(
        [(r, i, T0 + timedelta(hours=r), y) for r, i, y in rows],
        "row_id bigint, id int, datetime timestamp_ntz, target double",
    )
    spec = SeriesSpec(keys=("id",), layout=layout, chunk_rows=2)

    def run(**kw):
        return [r.target for r in forward_fill(df, spec, ["target"], **kw).orderBy("row_id").collect()]

    assert run(scope="frame", order="row_id") == [10, 20, 20, 21, 12, 12]
    assert run(scope="series") == [10, 20, 10, 21, 12, 21]
    assert forward_fill(df, spec, ["target"]).columns == df.columns


@pytest.mark.parametrize("layout", LAYOUTS)
def test_continuity(spark, layout):
    series = {0: (0, 1, 2), 1: (0, 1, 3), 2: (10, 11, 12), 3: (5,)}
    df, spec = panel(spark, {k: [(t, 1) for t in hours(*h)] for k, h in series.items()}, layout, 2)
    found = {r.id: r.max_steps for r in discontinuous_series(df, spec).collect()}
    assert found == {1: 2.0, 3: None}
    found = {r.id: r.max_steps for r in discontinuous_series(df, spec, "frame").collect()}
    assert found == {1: 2.0, 2: 7.0, 3: -7.0}
    assert {r.id for r in drop_discontinuous(df, spec).collect()} == {0, 2}
    assert {r.id for r in drop_discontinuous(df, spec, "frame").collect()} == {0}


@pytest.mark.parametrize(("layout", "chunk_rows"), [("whole", 1), ("chunked", 1), ("chunked", 5), ("auto", 3)])
def test_lags(spark, layout, chunk_rows):
    df, spec = panel(spark, {7: [(t, i + 1) for i, t in enumerate(hours(*range(12)))]}, layout, chunk_rows)
    rolled = add_rolling_mean(df, spec, 2, 3).orderBy("datetime").collect()
    assert [r.rolling_mean_lag2_window_size3 for r in rolled] == [None] * 4 + [float(v) for v in range(2, 10)]
    grown = add_expanding_mean(df, spec, 2).orderBy("datetime").collect()
    assert [r.expanding_mean_lag2 for r in grown] == [None] * 2 + [1 + i / 2 for i in range(10)]
    lagged = add_lags(df, spec, [1, 4], "{col}_lag_{k}").orderBy("datetime").collect()
    assert [r.target_lag_4 for r in lagged] == [None] * 4 + [float(v) for v in range(1, 9)]
    assert add_lags(df, spec, [1, 4], dropna=True).count() == 8


@pytest.mark.parametrize("by", ["row", "time"])
def test_folds(spark, by):
    df, spec = panel(spark, {0: [(t, i) for i, t in enumerate(hours(*range(14)))]})
    blocks = [r.block for r in expanding_folds(df, spec, 5, by=by).orderBy("datetime").collect()]
    assert [blocks.index(i) for i in range(1, 6)] == [4, 6, 8, 10, 12]
    assert blocks == sorted(blocks)


def test_folds_with_equal_times(spark):
    df, spec = panel(spark, {k: [(t, k) for t in hours(0, 1, 2)] for k in range(11)})
    sizes = {r.block: r["count"] for r in expanding_folds(df, spec, 4).groupBy("block").count().collect()}
    assert sizes == {0: 9, 1: 6, 2: 6, 3: 6, 4: 6}
    whole = expanding_folds(df, spec, 4, by="time").groupBy("datetime").agg(F.count_distinct("block").alias("n"))
    assert {r.n for r in whole.collect()} == {1}


def test_cutoff(spark):
    df, spec = panel(spark, {k: [(t, k) for t in hours(0, 1, 2, 3, 4)] for k in range(3)})
    assert cutoff_at_fraction(df, spec, 0.80).first().cutoff == hours(4)[0]
    assert cutoff_at_fraction(df, spec, 0.79).first().cutoff == hours(3)[0]


@pytest.mark.parametrize("layout", LAYOUTS)
def test_pacf(spark, layout):
    df, spec = panel(spark, {1: list(zip(hours(*range(8)), [1, 3, 2, 5, 4, 6, 5, 8], strict=True))}, layout)
    expected = {
        "ywm": ([1, 0.244718, 0.411972, -0.181338], [1, 0.244718, 0.374513, -0.415771]),
        "ywadjusted": ([1, 0.279678, 0.549296, -0.290141], [1, 0.279678, 0.511050, -0.746194]),
    }
    for method, (r, phi) in expected.items():
        got = acf(df, spec, 3, adjusted=method != "ywm").orderBy("lag").collect()
        assert [x.acf for x in got] == pytest.approx(r, abs=1e-6)
        got = pacf(df, spec, 3, method).orderBy("lag").collect()
        assert [x.pacf for x in got] == pytest.approx(phi, abs=1e-6)
        assert got[0].lower == got[0].upper == 1.0
        assert got[1].upper - got[1].pacf == pytest.approx(0.692952, abs=1e-6)
    best = top_lags(pacf(df, spec, 3, "ywm"), ["id"], 2).orderBy("rank").collect()
    assert [x.lag for x in best] == [0, 2]


def test_pacf_of_a_series_with_nulls_or_without_variance(spark):
    df, spec = panel(
        spark, {1: list(zip(hours(0, 1, 2), [1, None, 2], strict=True)), 2: [(t, 5) for t in hours(0, 1, 2)]}
    )
    assert all(r.pacf is None for r in pacf(df, spec, 1).collect())


def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in (0.1, 1.0, 1.0, 10.0, 100.0, 1000.0, 0.0, -3.0, None)], "x double")
    got = histogram(df, "x", log=True).orderBy("bin").collect()
    assert [r["count"] for r in got] == [1, 2, 1, 2]
    assert [r.left for r in got] + [got[-1].right] == [-1, 0, 1, 2, 3]
    assert dropped_by_log(df, "x").first().dropped == 2
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 10, 20, 21, 22, 50)], "x double")
    got = histogram(df, "x").orderBy("bin").collect()
    assert [r.left for r in got] + [got[-1].right] == pytest.approx([1, 10.8, 20.6, 30.4, 40.2, 50])
    assert sum(r["count"] for r in got) == 9
    assert histogram(df.filter("x < 0"), "x").count() == 0
    assert [r["count"] for r in histogram(df.filter("x = 50"), "x").collect()] == [1]


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (4.0,), (float("nan"),)], "x double")
    r = describe_columns(df).first()
    assert (r["count"], r.min, r.p25, r.p50, r.p75, r.max) == (3, 1, 1.5, 2, 3, 4)
    assert (r["mean"], r["std"]) == (pytest.approx(2.333333, abs=1e-6), pytest.approx(1.527525, abs=1e-6))


def test_resample(spark):
    d = [datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 7), datetime(2024, 1, 3, 1)]
    df, spec = panel(spark, {0: list(zip(d, [1, None, 3], strict=True))})
    total = resample(df, spec, "1 day", "sum").orderBy("datetime").collect()
    assert [r.target for r in total] == [1, 0, 3]
    mean = resample(df, spec, "1 day", "mean", keys=()).orderBy("datetime").collect()
    assert [(r.datetime, r.target) for r in mean] == [
        (datetime(2024, 1, 1), 1.0), (datetime(2024, 1, 2), None), (datetime(2024, 1, 3), 3.0),
    ]
    assert resample(df, spec, "1 day", "mean", dense=False).count() == 2


def test_downcast(spark):
    df = spark.createDataFrame([(1, -1, 255, 70000), (300, 300, 0, 1)], "a bigint, b bigint, c bigint, d bigint")
    assert dict(downcast_ints(df).dtypes) == {"a": "int", "b": "bigint", "c": "smallint", "d": "bigint"}
    df = spark.createDataFrame([(0.713, 123456789.123), (1.5, 1e-12)], "x double, y double")
    assert dict(downcast_floats(df).dtypes) == {"x": "float", "y": "double"}


def test_null_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    assert drop_series(df, [1], "id").count() == 2
    assert keep_series(df, [1], "id").count() == 1


def test_weekday(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 13),), (datetime(2021, 1, 3),)], "t timestamp_ntz")
    a, b = add_date_features(df, "t", ("dayofweek", "hour", "weekofyear", "dayofyear")).orderBy(F.desc("t")).collect()
    assert (a.dayofweek, a.hour, a.dayofyear) == (0, 13, 1)
    assert (b.dayofweek, b.weekofyear) == (6, 53)
    assert df.select(utc_stamp(F.col("t"))).first()[0] == "20240101T130000UTC"


@pytest.mark.parametrize("layout", LAYOUTS)
def test_densify(spark, layout):
    # a gap longer than several chunks, a half-hour row off the grid, a row without a key
    df, spec = panel(spark, {0: [(t, 1) for t in hours(0, 1, 30, 31)], 1: [(t, 2) for t in hours(5, 6.5, 7)]}, layout)
    df = df.unionByName(df.limit(1).withColumn("id", F.lit(None).cast("int")))
    got = {k: [] for k in (0, 1)}
    for r in densify(df, spec).orderBy("id", "datetime").collect():
        got[r.id].append((r.datetime, r.target))
    assert [t for t, _ in got[0]] == hours(*range(32))
    assert [i for i, (_, v) in enumerate(got[0]) if v is not None] == [0, 1, 30, 31]
    assert got[1] == list(zip(hours(5, 6, 7), [2, None, 2], strict=True))
    assert missing_times(df, spec).count() == 28 + 1


def test_densify_months(spark):
    d = [datetime(2023, 11, 30), datetime(2024, 2, 29), datetime(2024, 3, 30)]
    df, spec = panel(spark, {0: [(t, 1) for t in d]})
    got = densify(df, spec.with_(step="1 month")).orderBy("datetime").collect()
    assert [r.datetime for r in got] == [
        datetime(2023, 11, 30), datetime(2023, 12, 30), datetime(2024, 1, 30), datetime(2024, 2, 29), datetime(2024, 3, 30),
    ]


def test_densify_refuses_duplicates(spark):
    df, spec = panel(spark, {0: [(t, 1) for t in hours(0, 1, 1)]})
    assert duplicate_times(df, spec).first().n_rows == 2
    with pytest.raises(PySparkException, match="two rows for one time"):
        densify(df, spec).collect()


def test_make_features_refuses_null_target(spark):
    df, spec = panel(spark, {0: [(t, None if i == 4 else i) for i, t in enumerate(hours(*range(12)))]})
    with pytest.raises(PySparkException, match="null target"):
        make_features(df, spec, FeatureSpec((2,), (2,), (3,))).collect()


def test_kde_against_direct_sum(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 1, 300), rng.normal(40, 0.1, 100)]).round(2)
    hue = ["a"] * 250 + ["b"] * 150
    df = spark.createDataFrame([(float(v), h) for v, h in zip(x, hue, strict=True)], "x double, hue string")
    for by in (None, "hue"):
        got = kde(df, "x", by=by, grid=50).toPandas()
        for name, g in got.groupby("hue") if by else [(None, got)]:
            v = x if name is None else x[[h == name for h in hue]]
            h = v.std(ddof=1) * len(v) ** -0.2
            grid = np.linspace(v.min() - 3 * h, v.max() + 3 * h, 50)
            want = np.exp(-0.5 * ((grid[:, None] - v) / h) ** 2).sum(1) / (len(x) * h * math.sqrt(2 * math.pi))
            g = g.sort_values("point")
            assert np.allclose(g.x, grid)
            assert np.allclose(g.density, want, rtol=1e-9, atol=1e-300)


def test_specs_round_trip():
    for s in (SeriesSpec(("a", "b"), step="1 month"), FeatureSpec(lags=(1, 2)), BacktestSpec(n_folds=3)):
        assert type(s).from_json(s.to_json()) == s
    with pytest.raises(ValueError):
        FeatureSpec.from_json('{"lag": [1]}')


@pytest.mark.parametrize("keys", [(3, 1, 70000, 200000), ("b", "a", "béta", "zz")])
def test_frame_boundary_and_codes_follow_the_key_order(spark, keys):
    from gridtide.operators.columns import as_category

    rows = [(k, T0 + timedelta(hours=i)) for i, k in enumerate(sorted(keys))]
    kind = "int" if isinstance(keys[0], int) else "string"
    df = spark.createDataFrame(rows, f"id {kind}, datetime timestamp_ntz")
    assert discontinuous_series(df, SeriesSpec(("id",)), "frame").collect() == [(sorted(keys)[0], None)]
    codes = {r.id: r.id_code for r in as_category(df, "id").collect()}
    assert codes == {k: i for i, k in enumerate(sorted(keys))}


def test_auto_layout(spark):
    from gridtide.operators.layout import settle

    df, spec = panel(spark, {0: [(t, 1) for t in hours(*range(20))], 1: [(t, 1) for t in hours(0, 3)]}, "auto", 4)
    assert settle(df, spec).layout == "whole"
    assert settle(df, spec.with_(whole_limit=10)).layout == "chunked"
    assert settle(df, spec.with_(unique=True)).layout == "whole"
    assert settle(df, spec.with_(unique=True, whole_limit=10)).layout == "chunked"
    assert settle(df, spec.with_(unique=True, step="1 month")).layout == "whole"
    # ten rows in one minute: pieces shorter than a step, same result
    crowd = [(T0 + timedelta(minutes=i / 10), None if i % 3 else i) for i in range(100)]
    df, spec = panel(spark, {0: crowd}, "auto", 4)
    cut = settle(df, spec.with_(whole_limit=10))
    assert cut.chunk_micros == 3_600_000_000 * 4 // 100
    a, b = (forward_fill(df, s, ["target"]).orderBy("datetime").collect() for s in (spec, cut))
    assert a == b


@pytest.mark.parametrize("zone", ["UTC", "Europe/Tallinn", "America/New_York"])
def test_time_arithmetic_ignores_the_session_zone(spark, zone):
    from gridtide.functions.steps import Step, micros

    texts = ["2021-03-28 03:30:00.123456", "2021-10-31 02:59:59.999999", "1969-12-31 23:59:59.5", "1900-01-01", "2024-02-29 12:00"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
        for r in df.select("t", micros("t").alias("m"), *[Step.parse(s).floor("t").alias(s) for s in ("1 hour", "15 minute", "1 month")]).collect():
            assert r.m == (r.t - datetime(1970, 1, 1)) // timedelta(microseconds=1)
            assert r["1 hour"] == r.t.replace(minute=0, second=0, microsecond=0)
            assert r["15 minute"] == r.t.replace(minute=r.t.minute // 15 * 15, second=0, microsecond=0)
            assert r["1 month"] == r.t.replace(day=1, hour=0, minute=0, second=0, microsecond=0)
        rows, spec = panel(spark, {k: [(t, k) for t in hours(0, 1, 2)] for k in range(11)})
        sizes = {r.block: r["count"] for r in expanding_folds(rows, spec, 4).groupBy("block").count().collect()}
        assert sizes == {0: 9, 1: 6, 2: 6, 3: 6, 4: 6}
        assert cutoff_at_fraction(rows, spec, 0.5).first().cutoff == hours(1)[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
