"""Stages, models, runs, requests and the stream, end to end on small tables."""

import json
import math
from datetime import datetime, timedelta

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from gridtide.functions.dates import add_date_features
from gridtide.operators.columns import ColumnDropper, features_and_label
from gridtide.operators.features import add_expanding_mean, add_lags, add_rolling_mean, make_features
from gridtide.operators.metrics import mae
from gridtide.operators.ordering import same_rows
from gridtide.operators.split import check_split, expanding_folds, time_split
from gridtide.plans import backtest as bt
from gridtide.plans import runs as rn
from gridtide.plans.model import fit_regressor, predict, regressor
from gridtide.plans.scoring import score_batch
from gridtide.plans.stages import feature_table, prepare_stages, preprocess
from gridtide.sources import readers, writers
from gridtide.sources.payload import from_split_json, to_split_json
from gridtide.spec import FeatureSpec, SeriesSpec
from gridtide.streaming.scoring import request_stream, score_stream

T0 = datetime(2023, 1, 1)
HEADER = "county,is_business,product_type,target,is_consumption,datetime,data_block_id,row_id,prediction_unit_id"
SMALL = FeatureSpec(lags=(2, 4), transform_lags=(2,), rolling_windows=(3,))
FEATURES = ["lag2", "lag4", "expanding_mean_lag2", "rolling_mean_lag2_window_size3", "hour"]
TREES = {"num_trees": 3, "max_depth": 3}


def raw_lines(n=60):
    lines, row = [HEADER], 0
    for h in range(n):
        for unit in (0, 1, 2):
            for flag in (0, 1):
                if unit == 2 and h == 9:
                    continue  # unit 2 has a gap
                y = "" if (unit, flag, h) == (1, 0, 20) else f"{50 + 20 * math.sin(h / 4) + unit + flag:.3f}"
                lines.append(f"{unit},0,1,{y},{flag},{T0 + timedelta(hours=h)},{h // 24},{row},{unit}")
                row += 1
    return lines


@pytest.fixture(scope="module")
def drop_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("drop")
    (d / "train.csv").write_text("\n".join([*raw_lines(), "x,0,1,1.0,0,2023-01-01 00:00:00,0,0,0", "1,2"]) + "\n")
    (d / "client.csv").write_text("a,b\n1,x\n")
    (d / "names.json").write_text(json.dumps({"0": "NORTH", "1": "SOUTH"}))
    return d


@pytest.fixture(scope="module")
def features(spark):
    rows = [(k, T0 + timedelta(hours=h), 50 + 20 * math.sin(h / 4 + k)) for k in range(4) for h in range(80)]
    df = spark.createDataFrame(rows, "id int, datetime timestamp_ntz, target double")
    spec = SeriesSpec(("id",))
    made = make_features(df, spec, SMALL).persist()
    yield made, spec
    made.unpersist()


def test_sources_and_stages(spark, drop_dir, tmp_path):
    landed = str(tmp_path / "raw")
    schemas = {"train": readers.OBSERVATIONS}
    names = writers.land_raw(spark, str(drop_dir), landed, schemas, lookup="names.json")
    assert names == ["client", "train", "names"]
    assert writers.land_raw(spark, str(drop_dir), landed, schemas, lookup="names.json") == []
    raw = readers.read_table(spark, f"{landed}/train")
    assert raw.count() == len(raw_lines()) - 1
    assert dict(raw.dtypes)["datetime"] == "timestamp_ntz"
    assert readers.read_table(spark, f"{landed}/train_rejects").count() == 2
    lookup = {r.id: r.name for r in readers.read_table(spark, f"{landed}/names").collect()}
    assert lookup == {"0": "NORTH", "1": "SOUTH"}
    assert readers.list_stage(spark, landed).filter("path like '%train/%.parquet'").count() >= 1
    # a bad line is left out whichever columns are read
    direct = readers.read_observations(spark, str(drop_dir / "train.csv"))
    assert direct.count() == direct.select("target").toPandas().shape[0] == raw.count()

    cutoff = T0 + timedelta(hours=39)
    made = prepare_stages(
        spark, str(drop_dir / "train.csv"), str(tmp_path / "pre"), str(tmp_path / "feat"), features=SMALL, cutoff=cutoff
    )
    pre = readers.read_table(spark, str(tmp_path / "pre"))
    assert pre.columns[0] == "target"
    assert pre.filter("target is null").count() == 0
    assert {r[0] for r in pre.select("prediction_unit_id").distinct().collect()} == {0, 1}
    check = check_split(pre).first()
    assert check.complete and check.n_train == 4 * 40 and check.n_test == 4 * 20
    assert (tmp_path / "feat" / "measure=consumption" / "split=test").is_dir()
    # each of the 2 units x 2 measures x 2 sides loses its first rows
    assert made.count() == 4 * (60 - 2 * SMALL.reach)
    assert made.columns[:6] == ["target", "county", "is_business", "product_type", "is_consumption", "prediction_unit_id"]
    assert "datetime" not in made.columns and "row_id" not in made.columns
    headed = feature_table(pre, features=SMALL, keep_test_head=True)
    assert headed.filter("split = 'test'").count() == 4 * 20
    before = (tmp_path / "feat" / "_SUCCESS").stat().st_mtime_ns
    prepare_stages(spark, "gone.csv", str(tmp_path / "pre"), str(tmp_path / "feat"))
    assert (tmp_path / "feat" / "_SUCCESS").stat().st_mtime_ns == before


def test_fill_of_preprocessing(spark, drop_dir):
    raw = readers.read_observations(spark, str(drop_dir / "train.csv"))
    where = "prediction_unit_id = 1 and is_consumption = 0 and datetime = timestamp_ntz'2023-01-01 20:00:00'"
    series = preprocess(raw, fill="series").filter(where).first().target
    frame = preprocess(raw, fill="frame").filter(where).first().target
    assert series == pytest.approx(50 + 20 * math.sin(19 / 4) + 1, abs=1e-3)  # the hour before
    assert frame == pytest.approx(50 + 20 * math.sin(20 / 4), abs=1e-3)  # the row before: unit 0


def test_features_equal_their_parts(spark, features):
    made, spec = features
    base = made.sparkSession.createDataFrame(
        [(k, T0 + timedelta(hours=h), 50 + 20 * math.sin(h / 4 + k)) for k in range(4) for h in range(80)],
        "id int, datetime timestamp_ntz, target double",
    )
    parts = add_lags(base, spec, SMALL.lags)
    parts = add_expanding_mean(parts, spec, 2)
    parts = add_rolling_mean(parts, spec, 2, 3)
    parts = add_date_features(parts.na.drop("any"), "datetime")
    assert made.columns == parts.columns
    rounded = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in made.dtypes]
    assert same_rows(made.select(*rounded), parts.select(*rounded)).first().same
    default = FeatureSpec()
    assert default.reach == 168
    assert made.groupBy("id").count().select("count").distinct().collect() == [(80 - SMALL.reach,)]


def test_history_keeps_every_test_row(spark):
    rows = [(k, T0 + timedelta(hours=h), float(h + k)) for k in range(3) for h in range(40)]
    df = spark.createDataFrame(rows, "id int, datetime timestamp_ntz, target double")
    cut = T0 + timedelta(hours=29)
    train, test = df.filter(F.col("datetime") <= cut), df.filter(F.col("datetime") > cut)
    for layout in ("whole", "chunked"):
        spec = SeriesSpec(("id",), layout=layout, chunk_rows=4)
        full = make_features(df, spec, SMALL).filter(F.col("datetime") > cut).drop("expanding_mean_lag2")
        made = make_features(test, spec, SMALL, history=train).drop("expanding_mean_lag2")
        assert made.count() == 30
        assert same_rows(full, made).first().same


def test_model_is_deterministic_and_beats_the_mean(spark, features):
    made, _ = features
    a, b = (fit_regressor(made, FEATURES, "target", {**TREES, "learning_rate": 0.5}, seed=1) for _ in range(2))
    pa = predict(a, made).select("prediction").toPandas()
    assert pa.equals(predict(b, made).select("prediction").toPandas())
    error = mae(predict(a, made), "target", "prediction").first().mae
    mean = made.agg(F.avg("target")).first()[0]
    assert error < 0.8 * made.agg(F.avg(F.abs(F.col("target") - mean))).first()[0]
    with pytest.warns(UserWarning, match="num_leaves"):
        regressor(FEATURES, "target", {"num_leaves": 5})
    with pytest.raises(ValueError, match="unknown parameter"):
        regressor(FEATURES, "target", {"trees": 5})


def test_backtest_and_sweep(spark, features, tmp_path):
    made, spec = features
    folds = expanding_folds(made, spec, 3).persist()
    got = bt.backtest(folds, regressor(FEATURES, "target", TREES), "target", 3).collect()
    errors = [r.mae for r in got]
    mean = sum(errors) / 3
    assert got[0].cv_mean == pytest.approx(mean)
    assert got[0].cv_std == pytest.approx(math.sqrt(sum((e - mean) ** 2 for e in errors) / 3))
    space = [{**p, "high": 4} if p["name"] in ("num_trees", "max_depth") else p for p in bt.SPACE]
    path = str(tmp_path / "trials")
    for _ in range(2):
        bt.sweep(folds, FEATURES, "target", space, n_trials=2, k=2, study="a", path=path)
    trials = bt.trials_table(spark, path, "a")
    rows = trials.collect()
    assert [r.number for r in rows] == [0, 1, 2, 3]
    assert len({json.dumps(r.params, sort_keys=True) for r in rows}) == 4
    assert [r.best_value for r in rows] == [min(x.value for x in rows[: i + 1]) for i in range(4)]
    assert bt.best_params(trials) == min(rows, key=lambda r: r.value).params
    assert bt.top_trials(trials, 2).count() == 2
    folds.unpersist()


def test_features_of_a_sweep_are_assembled_once(spark, features, monkeypatch):
    """All fits read the same assembled rows, by block, and err as whole pipelines do on the rows of their folds."""
    made, spec = features
    folds = expanding_folds(made, spec, 3).persist()
    estimators = [regressor(FEATURES, "target", {**TREES, "num_trees": n}) for n in (2, 3)]
    assembled, seen, transform, error = [], [], VectorAssembler._transform, bt.fold_error
    monkeypatch.setattr(VectorAssembler, "_transform", lambda self, df: assembled.append(1) or transform(self, df))
    monkeypatch.setattr(bt, "fold_error", lambda df, *job: seen.append(df) or error(df, *job))
    rows, fitted = bt._fold_rows(folds, estimators, "target", FEATURES)
    got = bt._fold_errors(rows, fitted, "target", 3, 2)
    assert len(assembled) == 1 and len(seen) == 6
    assert rows.count() == folds.filter("target IS NOT NULL AND block IS NOT NULL").count()
    raw = rows.drop("features")
    want = [[error(raw, e, "target", fold) for fold in (1, 2, 3)] for e in estimators]
    assert got == [pytest.approx(e, rel=1e-9) for e in want]
    assert "PartitionFilters: [isnotnull(block" in rows.filter("block < 2")._jdf.queryExecution().executedPlan().toString()
    # another assembly for each: nothing is shared, and raw columns stay
    apart = [regressor(FEATURES[:n], "target", TREES) for n in (2, 3)]
    rows, fitted = bt._fold_rows(folds, apart, "target", FEATURES)
    assert fitted == apart and set(rows.columns) == {*FEATURES, "target", "block"}
    folds.unpersist()


def test_fits_side_by_side():
    assert [bt._side_by_side(12, parts) for parts in (0, 1, 12, 16, 24, 1000)] == [48, 48, 4, 3, 2, 2]


def test_sampled_parameters():
    a = bt.sample_params(bt.SPACE, 50, seed=3)
    assert a == bt.sample_params(bt.SPACE, 50, seed=3) and a[10:] == bt.sample_params(bt.SPACE, 40, 3, first=10)
    assert {d["num_trees"] for d in a} == set(range(3, 11))
    assert all(0.001 <= d["learning_rate"] <= 0.1 for d in a)
    assert sum(d["learning_rate"] < 0.01 for d in a) > 10  # log scale


def test_runs(spark, features, tmp_path):
    made, _ = features
    store = str(tmp_path / "store")
    train, test = made.filter("hour < 18"), made.filter("hour >= 18")
    for trees in (2, 4, 4):
        rn.evaluate_run(train, test, FEATURES, "target", store, "e1", {**TREES, "num_trees": trees}, trial=trees)
    runs = rn.search_runs(spark, store, "e1")
    assert runs.count() == 3 and rn.search_runs(spark, store, "other").count() == 0
    newest = runs.first()
    assert newest.tags["run_name"].startswith("TrialNumber4-") and newest.params["num_trees"] == "4"
    assert rn.delete_duplicate_runs(spark, store, "e1") == 1
    left = rn.search_runs(spark, store, "e1")
    assert left.count() == 2 and left.first().run_id == newest.run_id
    assert rn.search_runs(spark, store, "e1", deleted=True).count() == 3
    best = min(left.collect(), key=lambda r: r.metrics["test_mae"])
    assert rn.promote_best(spark, store, "e1").first().run_id == best.run_id
    example = readers.read_table(spark, f"{best.artifact_uri}/example")
    assert rn.validate_model(f"{store}/champion/model", example).first().valid
    meta = spark.read.json(f"{store}/champion/metadata").first()
    assert meta.run_id == best.run_id


def test_run_dedupe_rules(spark):
    rows = [("a", 1, 1.0, 2.0), ("b", 3, 1.0, 2.0), ("c", 3, 1.0, 2.0), ("d", 2, None, 2.0), ("e", 1, None, 2.0)]
    runs = spark.createDataFrame(rows, "run_id string, start_time bigint, x double, y double")
    assert {r.run_id for r in rn.dedupe_runs(runs, ["x", "y"]).collect()} == {"b", "d", "e"}


def test_requests(spark):
    good = '{"dataframe_split":{"columns":["a","b"],"data":[[1,2.5],[3,null]]}}'
    texts = {
        0: good,
        1: "bad",
        2: '{"dataframe_split":{"columns":["a"],"data":[[1]]}}',
        3: '{"dataframe_split":{"columns":["a","b","a"],"data":[[1,2,3]]}}',
        4: '{"dataframe_split":{"columns":["a","b"],"data":[[1]]}}',
        5: '{"dataframe_split":{"columns":["z","b","a"],"data":[[9,2,1]]}}',
        6: None,
        7: '{"dataframe_split":{"columns":["a","b"],"data":[["x",1]]}}',
        8: '{"dataframe_split":{"columns":["a","b"],"data":[]}}',
        9: '{"dataframe_split":{"columns":["a","b"]}}',
        10: '{"dataframe_split":{"columns":["a","b"],"data":[[1,2],null]}}',
    }
    df = spark.createDataFrame(list(texts.items()), "id int, text string")
    got = from_split_json(df, "text", ["a", "b"], keep=["id"]).collect()
    fine = sorted((r.id, r.row, r.a, r.b) for r in got if r.error is None)
    assert fine == [(0, 0, 1.0, 2.5), (0, 1, 3.0, None), (5, 0, 1.0, 2.0)]
    errors = {r.id: r.error for r in got if r.error is not None}
    assert set(errors) == {1, 2, 3, 4, 6, 7, 8, 9, 10} and len(got) == 12
    assert errors[2] == "missing columns: b" and errors[3] == "repeated column" and errors[8] == "no rows"
    rows = spark.createDataFrame([(i, float(i), None if i == 2 else i / 4) for i in range(5)], "n bigint, a double, b double")
    sent = to_split_json(rows, ["a", "b"], 2, "n")
    assert sent.count() == 3
    back = from_split_json(sent, "payload", ["a", "b"], keep=["request"])
    assert same_rows(back.select("a", "b"), rows.select("a", "b")).first().same
    assert json.loads(sent.filter("request = 1").first().payload) == {
        "dataframe_split": {"columns": ["a", "b"], "data": [[2.0, None], [3.0, 0.75]]}
    }


def test_scoring_in_batch_and_as_a_stream(spark, features, tmp_path):
    made, _ = features
    model = fit_regressor(made, FEATURES, "target", TREES)
    rows = made.withColumn("n", F.expr("id * 1000L + timestampdiff(HOUR, timestamp_ntz'2023-01-01', datetime)"))
    sent = to_split_json(rows, FEATURES, 10, "n").withColumn("request", F.col("request").cast("bigint"))
    bad = spark.createDataFrame([(-1, "bad")], "request bigint, payload string")
    sent = sent.unionByName(bad)
    answers = {r.request: r for r in score_batch(model, sent).collect()}
    assert answers[-1].predictions is None and answers[-1].error == "malformed request"
    want = predict(model, rows).selectExpr("floor(n / 10) as request", "n", "prediction").orderBy("n").collect()
    by_request = {}
    for r in want:
        by_request.setdefault(r.request, []).append(r.prediction)
    assert {k: list(a.predictions) for k, a in answers.items() if k >= 0} == by_request

    inbox, sink = str(tmp_path / "inbox"), str(tmp_path / "sink")
    saved = str(tmp_path / "model")
    model.write().save(saved)
    loaded = PipelineModel.load(saved)
    for part in (sent.filter("request < 100"), sent.filter("request >= 100")):
        part.coalesce(1).write.mode("append").parquet(inbox)
        query = score_stream(loaded, request_stream(spark, inbox), sink, str(tmp_path / "ckpt"), available_now=True)
        assert query.awaitTermination(120)
    out = spark.read.parquet(sink)
    assert out.filter("error is not null").count() == 1
    assert out.filter("error is null").count() == made.count()
    assert same_rows(
        out.filter("error is null").select("request", "prediction"),
        predict(model, rows).selectExpr("floor(n / 10) as request", "prediction"),
    ).first().same


def test_column_dropper_and_vectors(spark, features, tmp_path):
    made, _ = features
    pipe = Pipeline(stages=[ColumnDropper(columns=["id", "datetime"])]).fit(made)
    assert "id" not in pipe.transform(made).columns
    pipe.write().save(str(tmp_path / "pipe"))
    assert "id" not in PipelineModel.load(str(tmp_path / "pipe")).transform(made).columns
    xy = features_and_label(made.drop("id"), "target")
    assert xy.columns == ["features", "label"] and xy.first().features.size == len(FEATURES) + 2


def test_time_split_leaves_null_times_out(spark):
    df = spark.createDataFrame([(T0,), (T0 + timedelta(hours=1),), (None,)], "datetime timestamp_ntz")
    check = check_split(time_split(df, SeriesSpec(("datetime",)), T0)).first()
    assert (check.n_train, check.n_test, check.complete) == (1, 1, False)
