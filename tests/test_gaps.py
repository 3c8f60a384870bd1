"""Gaps of any length are spread over tasks before their points exist."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridtide import SeriesSpec
from gridtide.operators import calendar

SPEC = SeriesSpec(("id",), time="t", target="y", step="1 second")


@pytest.fixture()
def holes(spark):
    start = datetime(2000, 1, 1)
    at = [("a", 0), ("a", 200_000), ("b", 3), ("b", 4), ("b", 9), ("b", 5_000), ("c", 7), ("d", 0), ("d", 64), ("d", 129)]
    return spark.createDataFrame([(k, start + timedelta(seconds=s), float(s)) for k, s in at], "id string, t timestamp_ntz, y double")


def test_long_gaps_are_the_same_in_both_layouts(holes, monkeypatch):
    monkeypatch.setattr(calendar, "_STRETCH", 64)
    monkeypatch.setattr(calendar, "_FAN", 16)
    for build in (calendar.densify, calendar.missing_times):
        whole, pieces = (build(holes, SPEC.with_(layout=x, chunk_rows=100)) for x in ("whole", "chunked"))
        assert whole.columns == pieces.columns and whole.count() == pieces.count()
        assert whole.exceptAll(pieces).isEmpty() and pieces.exceptAll(whole).isEmpty()


def test_a_gap_is_spread_evenly(spark, holes, monkeypatch):
    monkeypatch.setattr(calendar, "_STRETCH", 64)
    monkeypatch.setattr(calendar, "_FAN", 16)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dense = calendar.densify(holes.filter("id = 'a'"), SPEC.with_(layout="chunked"))
        tasks = [r["count"] for r in dense.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(tasks) == 200_001
    big = [n for n in tasks if n > 2]
    assert len(big) == parts and max(big) < 1.2 * 200_001 / parts


def test_bins_of_an_outlier(spark):
    """Far more bins than rows: empty ones come as runs, and together all bins are there."""
    from gridtide.operators import distribution

    rows = [(float(i % 97), "a" if i % 3 else "b") for i in range(20_000)] + [(1e12, "a"), (-5.0, None)]
    df = spark.createDataFrame(rows, "x double, g string")
    for by in (None, "g"):
        got = distribution.histogram(df, "x", by=by).toPandas()
        assert got["count"].sum() == len(rows) and len(got) < 1000
        lo, hi, n = distribution.bin_edges(df, "x")
        assert n > 1 << 30
        for _, g in got.groupby(by, dropna=False) if by else [(None, got)]:
            g = g.sort_values("bin")
            assert g.left.iloc[0] == lo and g.right.iloc[-1] == hi and list(g.left[1:]) == list(g.right[:-1])
            assert not ((g["count"] == 0) & (g["count"].shift() == 0)).any()


def test_few_bins_listed_or_as_runs_hold_the_same(spark, monkeypatch):
    from gridtide.operators import distribution

    df = spark.createDataFrame([(float(x), g) for x, g in zip([1, 2, 2, 40, 41, 90, 100, 3], "aabbabab", strict=True)], "x double, g string")
    for by in ([], ["g"]):
        dense = distribution.histogram(df, "x", bins=50, by=by[0] if by else None)
        with monkeypatch.context() as m:
            m.setattr(distribution, "MOST_BINS", 10)
            sparse = distribution.histogram(df, "x", bins=50, by=by[0] if by else None)
        assert sparse.count() < dense.count()
        assert sparse.filter("count > 0").exceptAll(dense).isEmpty() and dense.filter("count > 0").exceptAll(sparse).isEmpty()
