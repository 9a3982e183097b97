import datetime as dt

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from featflow.operators import runs
from featflow.operators.models import (
    fit_pipeline,
    label_split,
    regression_metrics,
    save_model,
    score_batch,
)
from featflow.session import fresh_path


def test_latest_run_tie_break_and_search(spark):
    path = fresh_path(spark, "runs-test")
    t = dt.datetime(2024, 1, 1)
    runs.log_run(spark, path, "e", {"Mean absolute error": 1.0}, run_id="a", start_time=t)
    runs.log_run(spark, path, "e", {"Mean absolute error": 2.0}, run_id="b", start_time=t)
    runs.log_run(spark, path, "f", {"Mean absolute error": 3.0}, run_id="c",
                 start_time=t - dt.timedelta(days=1))
    log = spark.read.parquet(path)
    latest = {r["experiment"]: r["run_id"] for r in runs.latest_runs(log).collect()}
    assert latest == {"e": "b", "f": "c"}
    s = runs.search_runs(log, "e").collect()
    assert {r["metrics_mean_absolute_error"] for r in s} == {1.0, 2.0}


def test_versions_and_stages(spark):
    rows = [("m", "2", "Staging", dt.datetime(2024, 1, 1), 1),
            ("m", "10", "Staging", dt.datetime(2024, 1, 2), 2),
            ("m", "10", "Archived", dt.datetime(2024, 1, 3), 3),
            ("n", "x", "None", dt.datetime(2024, 1, 1), 4)]
    v = spark.createDataFrame(rows, runs.VERSION_SCHEMA)
    latest = {r[0]: r[1] for r in runs.latest_model_version(v).collect()}
    assert latest == {"m": 10, "n": 1}  # numeric max, floor 1 for no numeric version
    assert {r[0]: r[1] for r in runs.resolve_stage(v, "Staging").collect()} == {"m": "2"}


def test_metrics_match_regression_evaluator(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet") \
        .withColumn("prediction", F.col("l_quantity") * 1500.0)
    m = regression_metrics(li, "l_extendedprice").collect()[0]
    for name in ("mae", "mse", "rmse", "r2"):
        ev = RegressionEvaluator(labelCol="l_extendedprice", metricName=name).evaluate(li)
        assert abs(m[name] - ev) <= 1e-9 * max(1.0, abs(ev))


def test_hash_split_fraction_and_determinism(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    a = label_split(li, ["l_orderkey", "l_linenumber"], 0.7)
    frac = a.where(F.col("split") == "train").count() / a.count()
    assert 0.65 < frac < 0.75
    b = label_split(li.repartition(7), ["l_orderkey", "l_linenumber"], 0.7)
    assert a.exceptAll(b).count() == 0


def test_saved_model_scores_all_rows_with_imputation(spark):
    df = spark.createDataFrame([(float(i), float(i % 3) if i % 4 else None, 2.0 * i) for i in range(60)],
                               "x double, f double, y double")
    model = fit_pipeline(df, ["x", "f"], "y", "dt", impute=True)
    path = save_model(model, fresh_path(spark, "model-test"), None, ["x", "f"])
    out = score_batch(spark, path, df.drop("y"))
    assert out.count() == 60 and out.where(F.col("prediction").isNull()).count() == 0
    assert set(out.columns) == {"x", "f", "prediction"}


def test_stage_log_round_trip_and_readers(spark):
    import uuid

    from featflow.sources import io, store
    path = fresh_path(spark, "stages-test")
    t = dt.datetime(2024, 1, 1)
    runs.log_stage(spark, path, "m", 1, "Staging", t, 1)
    runs.log_stage(spark, path, "m", 2, "Staging", t + dt.timedelta(hours=1), 2)
    runs.log_stage(spark, path, "m", 2, "Production", t + dt.timedelta(hours=2), 3)
    log = io.read_table(spark, path, "parquet")
    assert {r[0]: r[1] for r in runs.resolve_stage(log, "Staging").collect()} == {"m": "1"}
    assert {r[0]: r[1] for r in runs.resolve_stage(log, "Production").collect()} == {"m": "2"}
    rpath = fresh_path(spark, "runs-test2")
    runs.log_run(spark, rpath, "e", {"mse": 1.0}, run_id="x", start_time=t)
    runs.log_run(spark, rpath, "e", {"mse": 2.0}, run_id="y", start_time=t + dt.timedelta(1))
    assert runs.latest_run(spark.read.parquet(rpath), "e").collect()[0]["run_id"] == "y"
    name = f"featflow_test.r_{uuid.uuid4().hex[:8]}"
    store.create_table(spark, name, ["k"], df=spark.createDataFrame([(1, 2.0)], "k int, v double"))
    store.set_feature_table_tag(spark, name, "a", "1")
    store.delete_feature_table_tag(spark, name, "a")
    assert store.get_table(spark, name).tags == {}
    assert io.read_named(spark, name).count() == 1


def test_small_fractions_split(spark):
    df = spark.range(100_000)
    from featflow.operators.models import split_by_hash
    train, test = split_by_hash(df, ["id"], 0.004)
    n = train.count()
    assert 300 < n < 500 and test.count() == 100_000 - n
    assert split_by_hash(df, ["id"], 0.996)[1].count() > 300


def test_scoring_keeps_every_row_and_user_columns(spark):
    df = spark.createDataFrame([(float(i), float(i % 3) if i % 4 else None, 2.0 * i, "u")
                                for i in range(60)], "x double, f double, y double, f__d string")
    model = fit_pipeline(df, ["x", "f"], "y", "dt")
    assert (model.rows_used, model.rows_dropped) == (45, 15)
    path = save_model(model, fresh_path(spark, "model-test"), None, ["x", "f"])
    out = score_batch(spark, path, df.drop("y"))
    assert out.count() == 60 and out.where("prediction IS NULL").count() == 15
    assert set(out.columns) == {"x", "f", "f__d", "prediction"}
    filled = fit_pipeline(df, ["x", "f"], "y", "dt", impute=True)
    path = save_model(filled, fresh_path(spark, "model-test"), None, ["x", "f"])
    out = score_batch(spark, path, df.drop("y"))
    assert out.where("prediction IS NOT NULL").count() == 60
    assert set(out.columns) == {"x", "f", "f__d", "prediction"}


def test_sizing_runs_no_job(spark):
    from featflow.session import spread
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    wide = df.join(df.select("l_orderkey").distinct(), "l_orderkey")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sizing", "sizing")
    try:
        spread(df)
        spread(wide)
        assert list(tracker.getJobIdsForGroup("sizing")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_batch_log_compaction_and_name_clashes(spark):
    path = fresh_path(spark, "runs-batch")
    ids = runs.log_runs(spark, path, [dict(experiment="e", metrics={"R-2": 1.0, "r 2": 2.0}, run_id=str(i))
                                      for i in range(5)])
    runs.log_run(spark, path, "e", {"R-2": 3.0}, run_id="last")
    small = runs.compact_log(spark, path, fresh_path(spark, "runs-compact"))
    log = spark.read.parquet(small)
    assert log.count() == 6 and len(log.inputFiles()) == 1 and ids == list("01234")
    found = runs.search_runs(log, "e")
    assert found.columns[-2:] == ["metrics_r_2", "metrics_r_2_2"]
    assert found.where("metrics_r_2 = 1 AND metrics_r_2_2 = 2").count() == 5


def test_model_files_by_version_and_stage(spark):
    path = fresh_path(spark, "stage-paths")
    t = dt.datetime(2024, 1, 1)
    runs.log_stage(spark, path, "m", 1, "Production", t, 1, model_path="/models/1")
    runs.log_stage(spark, path, "m", 10, "Staging", t, 2, model_path="/models/10")
    log = spark.read.parquet(path)
    assert runs.model_path(log, "m", version=1) == "/models/1"
    assert runs.model_path(log, "m", stage="Production") == "/models/1"
    assert runs.model_path(log, "m") == "/models/10"
    import pytest
    with pytest.raises(LookupError):
        runs.model_path(log, "m", stage="Archived")
