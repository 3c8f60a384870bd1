"""Null times, stage tables and value ranges: what both layouts must agree on, and plans that do not grow with the chain."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridtide import FeatureSpec, SeriesSpec
from gridtide.operators import autocorr, calendar, columns, continuity, features, fill, metrics, order_stats, profile
from gridtide.operators import split as splits

SPEC = SeriesSpec(("id",), time="t", target="y", step="1 hour")


def both(frame, spec, build):
    out = [sorted(map(str, build(frame, s).collect())) for s in (spec.with_(layout="whole"), spec.with_(layout="chunked", chunk_rows=4))]
    assert out[0] == out[1]
    return out[0]


@pytest.fixture()
def rows(spark):
    """Two series; one has a row without a time, one is short."""
    start = datetime(2024, 1, 1)
    data = [("a", start + timedelta(hours=i), float(i) if i % 4 else None) for i in range(13)]
    data += [("a", None, None), ("b", start, 5.0), ("b", start + timedelta(hours=1), None), (None, start, 1.0)]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "id string, t timestamp_ntz, y double")


@pytest.mark.parametrize(
    "build",
    [
        lambda d, s: continuity.time_steps(d, s),
        lambda d, s: continuity.drop_discontinuous(d, s),
        lambda d, s: fill.forward_fill(d, s),
        lambda d, s: features.add_lags(d, s, [1, 3]),
        lambda d, s: features.add_expanding_mean(d, s, 2),
        lambda d, s: features.add_rolling_mean(d, s, 1, 2),
        lambda d, s: features.make_features(d.fillna(0.5), s, FeatureSpec((1, 2), (1,), (2,), True, ()), dropna=False),
        lambda d, s: calendar.densify(d, s),
        lambda d, s: calendar.missing_times(d.filter("y <> 3 OR y IS NULL"), s),
        lambda d, s: autocorr.acf(d.fillna(0.5), s, 3),
    ],
)
def test_null_times_in_both_layouts(rows, build):
    assert both(rows, SPEC, build)


def test_null_time_is_last(rows):
    filled = fill.forward_fill(rows, SPEC.with_(layout="chunked", chunk_rows=4)).filter("t IS NULL").first()
    assert filled.y == 11.0


def test_chain_of_pieces_reads_stage_tables(rows):
    spec = SPEC.with_(layout="chunked", chunk_rows=4)
    timed = rows.filter("t IS NOT NULL")
    dense = calendar.densify(timed, spec)
    filled = fill.forward_fill(dense, spec)
    made = features.add_lags(filled, spec, [1, 2])

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges(made) <= 6 and exchanges(filled) <= 6


def test_order_statistics_without_local_tables(spark, monkeypatch):
    df = spark.range(3000).select((F.col("id") % 7).alias("g"), (F.pow(F.col("id") % 101, 2) / 3).alias("x"))
    want = sorted(map(str, profile.describe_columns(df, ["x"], by=["g"]).collect()))
    monkeypatch.setattr(order_stats, "collect_small", lambda df, limit=0: None)
    wide = order_stats.quantiles_wide(df, ["x"], [0.25, 0.5, 0.75], by=["g"])
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 3000") <= 5
    assert sorted(map(str, profile.describe_columns(df, ["x"], by=["g"]).collect())) == want


@pytest.mark.parametrize("kind", ["date", "timestamp", "double", "decimal(20,3)", "string"])
def test_categories_of_any_type(spark, kind):
    df = spark.range(400).select((F.col("id") % 23 * 1_000_003).alias("n"))
    value = {"date": "date_add(date'2000-01-01', cast(n / 1000003 as int))", "timestamp": "timestamp_seconds(n)", "string": "concat('Customer#', lpad(n, 12, '0'))"}
    df = df.select("n", F.expr(value.get(kind, f"cast(n as {kind})")).alias("v"))
    got = columns.as_category(df, "v").filter("v_code <> n / 1000003")
    assert got.count() == 0


def test_frame_fill_over_sparse_order(spark):
    ids = [i * 1_000_003 * 65536 for i in range(300)]
    df = spark.createDataFrame([(i, "m", float(k) if k % 5 == 0 else None) for k, i in enumerate(ids)], "r long, m string, y double")
    got = fill.forward_fill(df.repartition(5), SPEC.with_(keys=("m",), time="r"), ["y"], scope="frame", order="r").orderBy("r").collect()
    assert [r.y for r in got] == [float(k - k % 5) for k in range(300)]


def test_folds_of_repeated_ties(spark):
    days = [datetime(2024, 1, 1 + d) for d in (0, 1, 2) for _ in range((50, 50, 20)[d])]
    df = spark.createDataFrame([("ab"[i % 2], t, 1.0) for i, t in enumerate(days)], "id string, t timestamp_ntz, y double").repartition(4)
    got = splits.expanding_folds(df, SPEC, 5).groupBy("block").count().collect()
    assert {r.block: r["count"] for r in got} == dict.fromkeys(range(6), 20)


def test_folds_of_late_microseconds(spark):
    start = datetime(2300, 1, 1)
    df = spark.createDataFrame([("a", start + timedelta(microseconds=i), 1.0) for i in range(60)], "id string, t timestamp_ntz, y double")
    got = splits.expanding_folds(df, SPEC, 5).orderBy("t").collect()
    assert [r.block for r in got] == [i // 10 for i in range(60)]
    assert splits.cutoff_at_fraction(df, SPEC, 0.5).first().cutoff == start + timedelta(microseconds=30)


def test_long_tail_is_cut_in_pieces(rows):
    df = rows.filter("t IS NOT NULL")
    want = sorted(map(str, features.series_tail(df, SPEC, 2).collect()))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(features, "GROUP_LIMIT", 1)
        assert sorted(map(str, features.series_tail(df, SPEC, 2).collect())) == want


def test_integers_are_never_widened(spark):
    df = spark.createDataFrame([(70_000, 300)], "a int, b smallint")
    assert columns.downcast_ints(df).dtypes == df.dtypes


def test_scratch_needs_a_shared_folder(monkeypatch, spark):
    from gridtide import session

    class Context:
        master = "yarn"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        session.scratch(Session(), "x")


def test_nan_is_null_everywhere(spark):
    nan, start = float("nan"), datetime(2024, 1, 1)
    rows = [("a", start + timedelta(hours=i), v) for i, v in enumerate([1.0, nan, 3.0, None])]
    df = spark.createDataFrame(rows, "id string, t timestamp_ntz, y double")
    assert [r.y for r in fill.forward_fill(df, SPEC).orderBy("t").collect()] == [1.0, 1.0, 3.0, 3.0]
    assert profile.null_profile(df, ["y"]).first().nulls == 2 and columns.null_rows(df, "y").count() == 2
    assert metrics.mae(df.withColumn("z", F.lit(2.0)), "y", "z").first().mae == 1.0
    assert all(r.acf is None for r in autocorr.acf(df.limit(3), SPEC, 2).collect())
    with pytest.raises(Exception, match="null target"):
        features.make_features(df.limit(3), SPEC, FeatureSpec((1,), (), (), False, ()), dropna=False).collect()


def test_long_gaps_and_rows_off_the_grid(spark, monkeypatch):
    start = datetime(2024, 1, 1)
    rows = [("a", start, 1.0), ("a", start + timedelta(minutes=90), 2.0), ("a", start + timedelta(hours=50), 3.0), ("a", None, 4.0)]
    df = spark.createDataFrame(rows, "id string, t timestamp_ntz, y double")
    want = sorted(map(str, calendar.densify(df, SPEC).collect()))
    assert len(want) == 51
    monkeypatch.setattr(calendar, "_STRETCH", 7)
    assert sorted(map(str, calendar.densify(df, SPEC).collect())) == want
    assert sorted(r.y for r in calendar.off_grid_rows(df, SPEC).collect()) == [2.0, 4.0]
