"""Learning queries: whole jobs, cells and partition sizes."""

import math

import pytest
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from featflow import session
from featflow.operators import models as M
from featflow.operators.treeshap import ensemble_from_spark, shap_values
from featflow.plans import learning


def lineitem(spark, tmp_path, n=4000):
    spark.range(n).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"),
        (F.col("id") * 7 % 50 + 1).cast("double").alias("l_quantity"),
        (F.col("id") * 3 % 4 / 100).alias("l_discount"), (F.col("id") % 3 / 100).alias("l_tax"),
        (F.col("id") * 7 % 50 * 900 + F.col("id") * 31 % 97).cast("double").alias("l_extendedprice"),
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name,kind", [("rf_train_eval", "rf"), ("gbt_default_eval", "gbt_default"),
                                       ("gbt_train_eval", "gbt")])
def test_train_eval_checks_every_row_and_evaluates(spark, tmp_path, monkeypatch, name, kind):
    # Small learners, for time; the queries' own settings are those of `regressor`.
    plain = M.regressor
    small = {"rf": {"numTrees": 4}}.get(kind, {"maxIter": 4})
    monkeypatch.setattr(M, "regressor", lambda k, label, **p: plain(k, label, **{**small, **p}))
    out = learning.QUERIES[name](spark, lineitem(spark, tmp_path))
    assert out.count() == 4000
    assert out.where("NOT (trees_ok AND shap_ok AND reload_ok)").count() == 0
    sides = {r.split: r["count"] for r in out.groupBy("split").count().collect()}
    (m,) = out.select("model", "n", "mae", "mse", "rmse", "r2").distinct().collect()
    assert m.model == kind and m.n == sides["test"] and m.r2 > 0.5


def numbers(spark, n=5000):
    return spark.range(n).select(
        "id", (F.col("id") * 7 % 13).alias("a"), F.when(F.col("id") % 500 != 3, F.col("id") % 9 / 4).alias("b"),
        (F.col("id") * 7 % 13 * 3 + F.col("id") % 9 * (F.col("id") % 5)).cast("double").alias("y"))


@pytest.mark.parametrize("kind,params", [("dt", {}), ("gbt", {"maxIter": 6})])
def test_model_of_cells_is_the_model_of_rows(spark, monkeypatch, kind, params):
    df, names, fit_on = numbers(spark), ["a", "b"], []
    rows = M.fit_pipeline
    with monkeypatch.context() as mp:
        mp.setattr(M, "_CELL_GAIN", math.inf)
        plain = rows(df, names, "y", kind, **params)
    assert not any(isinstance(s, Bucketizer) for s in plain.stages)
    learner = GBTRegressor if kind == "gbt" else M.DecisionTreeRegressor
    fit = learner.fit
    monkeypatch.setattr(learner, "fit", lambda self, d, *a: (fit_on.append(d.count()), fit(self, d, *a))[1])
    made = M.fit_pipeline(df, names, "y", kind, **params)
    assert fit_on == [13 * 9]
    assert (made.rows_used, made.rows_dropped) == (plain.rows_used, plain.rows_dropped) == (4990, 10)
    want = {r.id: r.prediction for r in plain.transform(df).collect()}
    out = made.transform(df)
    assert out.columns == plain.transform(df).columns
    got = {r.id: r.prediction for r in out.collect()}
    assert got.keys() == want.keys() and len(got) == 4990
    assert all(abs(got[i] - want[i]) < 1e-7 for i in got)
    # Thresholds of the features, not of the bins: shares add up on the raw rows.
    path = M.save_model(made, M.model_dir(spark, "cells"), None, names)
    ens = ensemble_from_spark(spark, M.load_model(path), names)
    for r in shap_values(df, ens, names, ["id"], dtype="double", prefix="phi_",
                         prediction_col="trees").collect():
        assert abs(r.trees - got[r.id]) < 1e-9
        assert abs(r.expected_value + r.phi_a + r.phi_b - got[r.id]) < 1e-7
    scored = {r.id: r.prediction for r in M.score_batch(spark, path, df).collect()}
    assert len(scored) == 5000 and scored[3] is None and scored[4] == got[4]


def many_cells(spark):
    return numbers(spark).withColumn("c", F.col("id") * 13 % 29 / 8).withColumn(
        "y", F.col("y") + F.col("c") * F.col("a") + F.col("id") % 3)


def test_grown_model_is_the_model_of_rows(spark, monkeypatch):
    """boosting on many cells is grown in one stage, not by Spark ML's jobs per level."""
    df, names = many_cells(spark), ["a", "b", "c"]
    plain = M.fit_pipeline(df, names, "y", "gbt", maxIter=4)
    monkeypatch.setattr(M, "_GROWN_ROWS", 1)
    monkeypatch.setattr(GBTRegressor, "fit", None)
    made = M.fit_pipeline(df, names, "y", "gbt", maxIter=4)
    a, b = plain.stages[-1], made.stages[-1]
    assert (made.rows_used, made.rows_dropped) == (4990, 10)
    assert a.treeWeights == b.treeWeights and b.numFeatures == 3
    assert [t.toDebugString.count("If") for t in a.trees] == [t.toDebugString.count("If") for t in b.trees]
    assert all(abs(x - y) < 1e-9 for x, y in zip(a.featureImportances, b.featureImportances))
    want = {r.id: r.prediction for r in plain.transform(df).collect()}
    out = made.transform(df)
    assert out.columns == plain.transform(df).columns
    got = {r.id: r.prediction for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in got)
    path = M.save_model(made, M.model_dir(spark, "grown"), None, names)
    again = M.load_model(path)
    assert {r.id: r.prediction for r in again.transform(df).collect()} == got
    nodes, rows = (
        {(r.treeID, r.nodeData.id): r.nodeData for r in spark.read.parquet(f"{p}/data").collect()}
        for p in (_saved(spark, b), _saved(spark, a)))
    assert nodes.keys() == rows.keys()
    for k, n in nodes.items():
        r = rows[k]
        assert n.split.leftCategoriesOrThreshold == r.split.leftCategoriesOrThreshold
        assert n.rawCount == r.rawCount and n.leftChild == r.leftChild
        assert abs(n.impurity - r.impurity) < 1e-7 and abs(n.gain - r.gain) < 1e-7
        assert all(abs(x - y) < 1e-6 for x, y in zip(n.impurityStats, r.impurityStats))


def _saved(spark, model):
    path = M.model_dir(spark, "nodes")
    model.write().save(path)
    return path


def test_grown_model_of_constant_and_shallow_trees(spark, monkeypatch):
    monkeypatch.setattr(M, "_GROWN_ROWS", 1)
    monkeypatch.setattr(M, "_CELL_GAIN", math.inf)
    df = many_cells(spark).withColumn("d", F.lit(1.0)).coalesce(1)
    same = M.fit_pipeline(df, ["d"], "y", "gbt", maxIter=2)  # no cuts: Spark ML or one leaf
    (mean,) = df.agg(F.avg("y")).first()
    assert abs(same.transform(df).first().prediction - mean) < 1e-9
    flat = M.fit_pipeline(df.withColumn("y", F.lit(2.5)), ["a", "d"], "y", "gbt", maxIter=2)
    assert flat.stages[-1].totalNumNodes == 2
    assert flat.transform(df).first().prediction == 2.5
    stumps = M.fit_pipeline(df, ["a", "b"], "y", "gbt", maxIter=2, maxDepth=1)
    assert [t.numNodes for t in stumps.stages[-1].trees] == [3, 3]


@pytest.mark.parametrize("name,kind", [("rf_train_eval", "rf"), ("gbt_default_eval", "gbt_default"),
                                       ("gbt_train_eval", "gbt")])
def test_train_eval_has_every_row_of_the_former_sql(spark, tmp_path, monkeypatch, name, kind):
    """The SQL these queries had, over all line items, holds for their rows."""
    import duckdb
    plain = M.regressor
    small = {"rf": {"numTrees": 4}}.get(kind, {"maxIter": 4})
    monkeypatch.setattr(M, "regressor", lambda k, label, **p: plain(k, label, **{**small, **p}))
    folder = lineitem(spark, tmp_path, 1500)
    out = learning.QUERIES[name](spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM read_parquet('{folder}/lineitem.parquet/*.parquet')")
    want = con.execute(learning._CHECKS_SQL)
    columns = [d[0] for d in want.description]
    assert sorted(want.fetchall()) == sorted(map(tuple, out.select(*columns).collect()))


def test_forest_is_fit_on_bags_of_rows_added_up_per_cell(spark, tmp_path, monkeypatch):
    """a tree's fit reads the cells of its bag, however many rows there are."""
    monkeypatch.setattr(M, "_FOREST_GAIN", 8)
    monkeypatch.setattr(M, "_BAG_BYTES", 16 * 117 * 5)  # three passes for twelve trees
    df, names, fit_on = numbers(spark), ["a", "b"], []
    fit = M.RandomForestRegressor.fit
    monkeypatch.setattr(M.RandomForestRegressor, "fit", lambda self, d, *a: (
        fit_on.append(d.count()), fit(self, d, *a))[1])
    made = M.fit_pipeline(df, names, "y", "rf", numTrees=12, maxDepth=8, featureSubsetStrategy="1")
    assert len(fit_on) == 12 and max(fit_on) <= 13 * 9
    assert any(isinstance(s, Bucketizer) for s in made.stages)
    assert (made.rows_used, made.rows_dropped) == (4990, 10)
    path = M.save_model(made, M.model_dir(spark, "bags"), None, names)
    ens = ensemble_from_spark(spark, M.load_model(path), names)
    bags = [t.cover[0] for t in ens.trees]
    assert len(set(bags)) > 6 and all(abs(n - 4990) < 6 * 4990 ** 0.5 for n in bags)
    got = {r.id: r.prediction for r in made.transform(df).collect()}
    assert len(got) == 4990
    for r in shap_values(df, ens, names, ["id"], dtype="double", prefix="phi_",
                         prediction_col="trees").collect():
        assert abs(r.trees - got[r.id]) < 1e-9
        assert abs(r.expected_value + r.phi_a + r.phi_b - got[r.id]) < 1e-7
    scored = {r.id: r.prediction for r in M.score_batch(spark, path, df).collect()}
    assert len(scored) == 5000 and scored[3] is None and scored[4] == got[4]


def test_forest_of_cells_is_the_forest_of_rows(spark, monkeypatch):
    """With every row once in every bag, each tree is the tree of the rows."""
    df, names = numbers(spark), ["a", "b"]
    plain = M.fit_pipeline(df, names, "y", "rf", numTrees=3, bootstrap=False)
    assert not any(isinstance(s, Bucketizer) for s in plain.stages)
    monkeypatch.setattr(M, "_FOREST_GAIN", 8)
    monkeypatch.setattr(M, "_bagged", lambda rows, trees, cells, seed: rows.groupBy("cell").agg(
        F.count("*").cast("double").alias("weight"), F.sum("y").alias("total")).select(
        F.explode(F.array(*map(F.lit, trees))).alias("tree"), "cell", "weight", "total"))
    made = M.fit_pipeline(df, names, "y", "rf", numTrees=3)
    assert made.stages[-1].getNumTrees == 3 and any(isinstance(s, Bucketizer) for s in made.stages)
    want = {r.id: r.prediction for r in plain.transform(df).collect()}
    out = made.transform(df)
    assert out.columns == plain.transform(df).columns
    got = {r.id: r.prediction for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-7 for i in got)


def test_bags_take_every_row_by_itself(spark):
    n = 20_000
    rows = spark.range(0, n, 1, 3).select(F.col("id").cast("int").alias("cell"), (F.col("id") / 8).alias("y"))
    got = {(r.tree, r.cell): (r.weight, r.total) for r in M._bagged(rows, [4, 5], n, 42).collect()}
    assert all(total == weight * cell / 8 for (_, cell), (weight, total) in got.items())
    weights = {t: [got.get((t, i), (0, 0))[0] for i in range(n)] for t in (4, 5)}
    for w in weights.values():
        for k in range(4):
            assert abs(w.count(k) / n - math.exp(-1) / math.factorial(k)) < 0.02
    both = sum(a * b for a, b in zip(weights[4], weights[5])) / n
    assert abs(both - 1) < 0.05  # independent of one another
    again = M._bagged(rows, [5], n, 42).collect()  # repeatable, in passes of any trees
    assert {r.cell: r.weight for r in again} == {c: w for (t, c), (w, _) in got.items() if t == 5}


def test_cuts_of_a_feature(spark):
    inf = math.inf
    few = spark.createDataFrame([(v,) for v in (1.0, 1.0, 2.0, -0.0, 0.0, inf, -inf, 4.0)], "x double")
    assert M.feature_cuts(few, "x", 32) == [0.0, 0.5, 1.5, 3.0, math.nextafter(4.0, inf)]
    many = spark.range(30_000).select((F.col("id") / 3).alias("x"))
    cuts = M.feature_cuts(many, "x", 32)
    assert len(cuts) == 31
    inside = [many.where((F.col("x") > a) & (F.col("x") <= b)).count() for a, b in
              zip([-inf, *cuts[:3]], cuts[:4])]
    assert all(abs(n - 30_000 / 32) < 60 for n in inside)
    assert M.feature_cuts(spark.createDataFrame([(5.0,)] * 4, "x double"), "x", 32) == []


def test_partitions_do_not_grow_with_the_input(spark, tmp_path, monkeypatch):
    df = spark.read.parquet(lineitem(spark, tmp_path, 20_000) + "/lineitem.parquet").coalesce(1)
    df.write.parquet(f"{tmp_path}/one")
    one = spark.read.parquet(f"{tmp_path}/one")
    cores = spark.sparkContext.defaultParallelism
    assert session.spread(one).rdd.getNumPartitions() == cores
    monkeypatch.setattr(session, "SPREAD_BYTES", 4096)
    assert session.spread(one).rdd.getNumPartitions() > 2 * cores
    assert session.spread(one).count() == 20_000
    # Rows a learner keeps: 250 bytes each, 8 a feature, 4 a tree.
    monkeypatch.setattr(M, "_KEPT_BYTES", 1 << 20)
    parts = M._dealt(one, 20_000, 3, 100).rdd.getNumPartitions()
    assert parts == math.ceil(20_000 * 674 / (1 << 20))
    assert M._dealt(one, 20_000, 3, 100).count() == 20_000
