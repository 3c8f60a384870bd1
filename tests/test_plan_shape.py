"""What the plans must look like to hold at scale."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridtide.catalog import QUERIES
from gridtide.catalog import queries as q
from gridtide.operators import columns, features, ordering, split
from gridtide.plans.runs import dedupe_runs

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="sample tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"\bExchange (?:hash|range|Single|round)", plan(df), re.I))


@pytest.fixture(scope="module")
def monthly(spark):
    at = q.scratch(spark, "monthly")
    q._monthly(spark, DATA).write.parquet(at)
    return spark.read.parquet(at)


WHOLE = q.MONTHLY.with_(layout="whole")
SLOW = {
    "backtest", "sweep", "best_trial", "search_runs", "validate_model", "score_batch", "score_stream",
    "predict",
}


def test_one_shuffle_for_all_features(monthly):
    made = features.make_features(monthly, WHOLE, q.MONTHLY_FEATURES)
    assert shuffles(made) == 1 and plan(made).count("Sort [") == 1


def test_fill_densify_and_features_share_one_shuffle(monthly):
    from gridtide.operators.calendar import densify
    from gridtide.operators.fill import forward_fill

    made = features.make_features(forward_fill(densify(monthly, WHOLE), WHOLE), WHOLE, q.MONTHLY_FEATURES)
    assert shuffles(made) == 1


def test_chunked_rows_never_shuffle_on_the_series_alone(monthly, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(features.make_features(monthly, WHOLE.with_(layout="chunked"), q.MONTHLY_FEATURES))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    alone = re.findall(r"hashpartitioning\(l_suppkey#\d+L?, \d+\)", text)
    # the only one is the table of pieces
    assert len(alone) == 1
    assert len(re.findall(r"hashpartitioning\(l_suppkey#\d+L?, _gt_\w+#\d+L?, \d+\)", text)) >= 2


def test_splitting_does_not_shuffle(spark):
    orders = q._table(spark, DATA, "orders")
    assert shuffles(split.time_split(orders, q.ORDERS, "2000-01-01 00:00:00")) == 0
    assert shuffles(split.expanding_folds(orders, q.ORDERS, 5)) == 0


def test_tails_are_cut_before_the_shuffle(monthly):
    assert plan(features.series_tail(monthly, WHOLE, 5)).count("WindowGroupLimit") == 2


def test_top_rows_do_not_sort_the_table(spark):
    assert "TakeOrderedAndProject" in plan(ordering.top_k(q._table(spark, DATA, "orders"), "o_totalprice", 10))


def test_listed_series_are_broadcast(spark):
    kept = columns.drop_series(q._table(spark, DATA, "events"), ["error"], "event_type")
    assert "BroadcastHashJoin" in plan(kept) and shuffles(kept) == 0


def test_runs_meet_keepers_on_their_own_key(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        runs = q._table(spark, DATA, "orders").withColumn("start_time", F.col("o_orderkey"))
        text = plan(dedupe_runs(runs, ["o_orderpriority"], key="o_orderkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"SortMergeJoin \[o_orderkey#\d+L?\]", text) and "partial_min" in text


def test_scans_read_what_is_needed(spark):
    text = plan(QUERIES["resample_mean"](spark, DATA))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,value:double>" in text
    text = plan(QUERIES["time_between"](spark, DATA))
    assert "GreaterThanOrEqual(ts," in text


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_no_query_pairs_all_rows(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_sources_avoid_what_does_not_survive_a_lost_executor():
    package = Path(q.__file__).resolve().parents[1]
    for path in package.rglob("*.py"):
        text = path.read_text()
        assert not re.search(r"localCheckpoint|crossJoin|\.rdd\b|toPandas|F\.broadcast", text), path
