"""Train, evaluate, save and batch-score tree regressors on Spark ML.

Training happens on the cluster (Spark ML's distributed tree learners), never
on a collected pandas frame.  Evaluation computes MAE, MSE, RMSE and R2 in one
aggregation pass.  A saved model carries its feature-lookup spec, so
:func:`score_batch` needs only the key columns of new rows.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, Imputer, ImputerModel, SQLTransformer, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from featflow.operators.grown import can_grow, fit_grown
from featflow.operators.lookup import FeatureLookup, TrainingSet, apply_lookups
from featflow.session import spread, staged

FEATURES_COL = "rawFeatures"


# ------------------------------------------------------------------ splits
def hash_fraction(key_cols: Sequence[str], seed: int = 42) -> Column:
    """A number in [0, 1) from the md5 of ``"<seed>:<key>"`` (32 bits of it; the
    same value in any SQL engine)."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def split_by_hash(df: DataFrame, key_cols: Sequence[str], train_fraction: float = 0.75,
                  seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Repeatable train/test split by key hash (independent of partitioning)."""
    h = hash_fraction(key_cols, seed)
    return df.where(h < train_fraction), df.where(h >= train_fraction)


def label_split(df: DataFrame, key_cols: Sequence[str], train_fraction: float = 0.75,
                seed: int = 42, col: str = "split") -> DataFrame:
    """Every row with a ``split`` column, ``train`` or ``test``."""
    return df.withColumn(col, F.when(hash_fraction(key_cols, seed) < train_fraction, "train")
                         .otherwise("test"))


def _key_hash(key_cols: Sequence[str], seed: int) -> Column:
    """60 bits of the md5 of ``"<seed>:<key>"`` (the same in any SQL engine)."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.col(f"`{c}`").cast("string") for c in key_cols])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def kth_smallest(values: DataFrame, k: int, low: int = 0, high: int = 1 << 60,
                 buckets: int = 4096) -> tuple[int, int, int]:
    """(value, how many lie below it, how many equal it) of the ``k``-th smallest
    of a column of whole numbers in [low, high).

    No sort: each pass counts ``buckets`` ranges (that many rows reach the
    driver) and narrows down to the one that holds the value, which the next
    pass's filter keeps; five passes at most for 60 bits.
    """
    name, below = values.columns[0], 0
    v = F.col(f"`{name}`")
    while True:
        width = max(1, -(-(high - low) // buckets))
        at = ((v - F.lit(low)) / F.lit(width)) if width == 1 else F.expr(
            f"(`{name}` - {low}L) div {width}L")
        counts = values.where((v >= low) & (v < high)).groupBy(
            at.cast("long").alias("b")).count().collect()
        for r in sorted(counts, key=lambda r: r["b"]):
            if below + r["count"] >= k:
                if width == 1:
                    return low + r["b"], below, r["count"]
                low, high = low + r["b"] * width, min(high, low + (r["b"] + 1) * width)
                break
            below += r["count"]
        else:
            raise ValueError("fewer values than k")


def split_exact(df: DataFrame, key_cols: Sequence[str], test_fraction: float = 0.25,
                seed: int = 42, col: str = "split") -> DataFrame:
    """Every row with a ``split`` column; the test side has exactly
    ``ceil(rows * test_fraction)`` rows, those whose keys hash lowest.

    Repeatable on any layout.  ``key_cols`` should identify a row: of the rows
    that share the last key taken, only as many as are still wanted are taken
    (by the order of their columns; in one task, as they are one key's rows).
    """
    h = _key_hash(key_cols, seed)
    n = df.count()
    k = min(n, math.ceil(n * test_fraction))
    if not k:
        return df.withColumn(col, F.lit("train"))
    cut, below, equal = kth_smallest(df.select(h.alias("h")), k)
    side = F.when(h <= cut, "test").otherwise("train")
    if below + equal == k:
        return df.withColumn(col, side)
    order = Window.orderBy(*[F.col(f"`{c}`") for c in df.columns])
    last = df.where(h == cut).withColumn(col, F.when(
        F.row_number().over(order) <= k - below, "test").otherwise("train"))
    return df.where(h != cut).withColumn(col, side).unionByName(last)


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = 42) -> list[DataFrame]:
    """``randomSplit`` (Bernoulli per row, seeded; depends on partitioning)."""
    return df.randomSplit(list(weights), seed=seed)


# --------------------------------------------------------------- learners
def regressor(kind: str, label: str, features_col: str = FEATURES_COL, **params):
    """``dt`` (decision tree), ``rf`` (forest: 100 trees, depth 6, 3 features
    per split by default), ``gbt`` (boosting: 100 rounds, depth 5 = at most
    32 leaves, squared loss) or ``gbt_default`` (boosting with the learner's
    own defaults: 20 rounds, depth 5)."""
    if kind == "dt":
        return DecisionTreeRegressor(featuresCol=features_col, labelCol=label, **params)
    if kind == "rf":
        p = {"numTrees": 100, "maxDepth": 6, "featureSubsetStrategy": "3", "seed": 42}
        p.update(params)
        return RandomForestRegressor(featuresCol=features_col, labelCol=label, **p)
    if kind == "gbt":
        p = {"maxIter": 100, "maxDepth": 5, "stepSize": 0.1, "lossType": "squared", "seed": 42}
        p.update(params)
        return GBTRegressor(featuresCol=features_col, labelCol=label, **p)
    if kind == "gbt_default":
        return GBTRegressor(featuresCol=features_col, labelCol=label, seed=42, **params)
    raise ValueError("kind must be 'dt', 'rf', 'gbt' or 'gbt_default'")


def assembler(feature_cols: Sequence[str], output_col: str = FEATURES_COL,
              handle_invalid: str = "skip") -> VectorAssembler:
    """Vector assembler; ``skip`` drops rows with a null or NaN feature."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=output_col,
                           handleInvalid=handle_invalid)


def _helpers(n: int) -> tuple[list[str], list[str]]:
    """Names of the columns an imputing pipeline adds (cast and filled)."""
    return [f"_ff_cast_{i}" for i in range(n)], [f"_ff_filled_{i}" for i in range(n)]


# Distinct values of a feature up to which their exact counts place the cuts.
_COUNTED_VALUES = 10_000
# Rows must outnumber the possible cells by this factor to be fit as cells.
_CELL_GAIN = 8
# The same for a forest, whose trees are then fit one by one.
_FOREST_GAIN = 256
# Bytes of sums that a task bagging rows holds; more trees take another pass.
_BAG_BYTES = 64 << 20
# Trees of a forest on cells that are fit side by side (as Spark jobs).
_TREES_AT_ONCE = 8
# Rows from which boosting on more cells is grown from histograms of binned rows (its
# barriers take a second per level whatever the rows).
_GROWN_ROWS = 1 << 23
# Settings of a learner under which a cell's count and mean stand for its rows.
_CELL_PARAMS = {"maxIter", "maxDepth", "stepSize", "seed", "maxBins", "lossType"}
_FOREST_PARAMS = {"numTrees", "maxDepth", "seed", "maxBins", "featureSubsetStrategy"}
# Estimated bytes of a partition of the rows a learner keeps in memory.
_KEPT_BYTES = 256 << 20


def feature_cuts(rows: DataFrame, feature: str, bins: int) -> list[float]:
    """At most ``bins - 1`` cuts midway between neighbouring values of a feature.

    All of them if there are few values; otherwise every cut closes a bin as
    near as possible to an equal share of the rows (the rule of Spark's tree
    learners, over all rows).  Up to 10,000 distinct values are counted exactly,
    more are represented by 10,000 quantiles of a mergeable sketch.
    """
    x = F.col(f"`{feature}`").cast("double")
    at = rows.groupBy((x + F.lit(0.0)).alias("v")).agg(F.count(F.lit(1)).alias("n")) \
        .limit(_COUNTED_VALUES + 1).collect()
    if len(at) <= _COUNTED_VALUES:
        counts = sorted((r["v"], r["n"]) for r in at)
    else:
        probs = [i / _COUNTED_VALUES for i in range(_COUNTED_VALUES + 1)]
        # Merging costs a sketch's size per partition: one per core, not per file.
        few = rows.select(x.alias("v")).coalesce(rows.sparkSession.sparkContext.defaultParallelism)
        found = few.agg(F.percentile_approx("v", probs, 100_000).alias("q")).first()["q"]
        counts = sorted(Counter(found).items())
    cuts = [_between(a, b) for (a, _), (b, _) in zip(counts, counts[1:])]
    if len(cuts) < bins:
        return sorted({c for c in cuts if math.isfinite(c)})
    stride = sum(n for _, n in counts) / bins
    chosen, target, before = [], stride, counts[0][1]
    for cut, (_, n) in zip(cuts, counts[1:]):
        if abs(before - target) < abs(before + n - target):
            chosen.append(cut)
            target += stride
        before += n
    return sorted({c for c in chosen if math.isfinite(c)})[:bins - 1]


def _between(a: float, b: float) -> float:
    """The middle of a < b, or else a number above ``a`` and at most ``b``."""
    middle = a / 2 + b / 2
    if math.isfinite(middle) and a < middle:
        return middle
    return b if math.isfinite(b) else math.nextafter(a, math.inf)


def _few_cells(rows: DataFrame, names: Sequence[str], n: int, bins: int,
               gain: float, found: list[list[float]] | None = None) -> list[list[float]] | None:
    """Cuts per feature if ``n`` rows are at least ``gain`` times the cells between
    them, else None; those that had to be looked for are left in ``found``."""
    cells, cuts = 1, [] if found is None else found
    for c in names:
        cuts.append(feature_cuts(rows, c, bins))
        cells *= len(cuts[-1]) + 1
        if cells * gain > n:
            return None
    return cuts


def _fit_cells(rows: DataFrame, names: Sequence[str], label: str, kind: str,
               cuts: Sequence[Sequence[float]], params: dict) -> PipelineModel:
    """A pipeline that bins its features, its learner fit on one weighted row per cell.

    Squared loss needs no more of rows with equal bins than their count and mean
    label: sums of labels and of residuals, gains and leaf values are those of
    the rows.  The learner's work is bounded by bins and features, not rows.
    A forest's trees have their own weights and means (:func:`_bagged`).
    """
    bins = [f"_ff_bin_{i}" for i in range(len(names))]
    binning = Bucketizer(splitsArray=[[-math.inf, *c, math.inf] if c else [-math.inf, 0.0, math.inf]
                                      for c in cuts],
                         inputCols=list(names), outputCols=bins, handleInvalid="skip")
    vector = assembler(bins)
    hide = SQLTransformer(statement="SELECT * EXCEPT (" + ", ".join(bins) + ") FROM __THIS__")
    y = F.col(f"`{label}`").cast("double")
    binned = binning.transform(rows)
    if kind == "rf":
        fitted = _fit_bags(binned, bins, [len(c) + 1 for c in cuts], vector, label, y, params)
        return PipelineModel([binning, vector, hide, fitted])
    cells = binned.groupBy(*bins).agg(
        F.avg(y).alias(label), F.count(F.lit(1)).cast("double").alias("_ff_weight"))
    # A sum has no metadata: bins marked as categories would be split as such.
    cells = cells.select(*[(F.col(b) + F.lit(0.0)).alias(b) for b in bins], f"`{label}`", "_ff_weight")
    with staged(rows.sparkSession, cells, "cells") as few:
        learner = regressor(kind, label, weightCol="_ff_weight", **params)
        fitted = learner.fit(vector.transform(few))
    return PipelineModel([binning, vector, hide, fitted])


def _fit_grown(rows: DataFrame, names: Sequence[str], label: str,
               learner: GBTRegressor, found: Sequence[list[float]]) -> PipelineModel | None:
    """A pipeline whose boosted trees are grown from histograms of binned rows
    (:mod:`featflow.operators.grown`), or None where these would be too large;
    ``found`` are the cuts of the first features."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    bins = learner.getMaxBins()
    with ThreadPool(min(len(names), _TREES_AT_ONCE)) as pool:
        cuts = [*found, *pool.map(inheritable_thread_target(rows.sparkSession)(
            lambda c: feature_cuts(rows, c, bins)), names[len(found):])]
    if not can_grow(rows.sparkSession, learner, cuts):
        return None
    return PipelineModel([assembler(names), fit_grown(rows, names, label, cuts, learner)])


def _bagged(rows: DataFrame, trees: Sequence[int], cells: int, seed: int) -> DataFrame:
    """(tree, cell, weight, total) of rows (cell, y): per tree and cell how often its
    rows are in the tree's bag, and the sum of their labels as often.

    Every row is in every bag Poisson(1) times, independently: of the n rows of a
    batch a bag takes Poisson(n), each any of the rows.  Draws are seeded by seed, tree
    and partition, so a repeated task draws the same.
    """
    def bag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part = TaskContext.get().partitionId()
        draws = [np.random.default_rng([seed % (1 << 64), t, part]) for t in trees]
        weight, total = np.zeros((len(trees), cells)), np.zeros((len(trees), cells))
        for batch in batches:
            cell, y, n = batch["cell"].to_numpy(), batch["y"].to_numpy(), len(batch)
            if not n:
                continue
            for k, draw in enumerate(draws):
                taken = draw.integers(0, n, draw.poisson(n))
                at = cell[taken]
                np.add.at(weight[k], at, 1.0)
                np.add.at(total[k], at, y[taken])
        for k, t in enumerate(trees):
            at = np.nonzero(weight[k])[0]
            yield pd.DataFrame({"tree": np.full(len(at), t, np.int32), "cell": at.astype(np.int32),
                                "weight": weight[k, at], "total": total[k, at]})

    return rows.mapInPandas(bag, "tree int, cell int, weight double, total double").groupBy(
        "tree", "cell").agg(F.sum("weight").alias("weight"), F.sum("total").alias("total"))


def _fit_bags(binned: DataFrame, bins: Sequence[str], counts: Sequence[int], vector: VectorAssembler,
              label: str, y: Column, params: dict) -> RandomForestRegressionModel:
    """A forest whose trees are fit, each by Spark ML, on a bag of the rows added up
    per cell; the rows are read once for all bags that fit a task's memory."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target
    learner = regressor("rf", label, **params)
    spark, n, seed = binned.sparkSession, learner.getNumTrees(), learner.getSeed()
    cells = math.prod(counts)
    place = F.lit(0)
    for b, count in zip(bins, counts):
        place = place * F.lit(count) + F.col(b).cast("int")
    rows = binned.select(place.alias("cell"), y.alias("y"))
    step = max(1, _BAG_BYTES // (16 * cells))
    sums = None
    for first in range(0, n, step):
        some = _bagged(rows, range(first, min(n, first + step)), cells, seed)
        sums = some if sums is None else sums.unionByName(some)
    values, below = [], F.col("cell")
    for b, count in zip(reversed(bins), reversed(counts)):
        values.append((below % F.lit(count)).cast("double").alias(b))
        below = F.floor(below / F.lit(count))
    bags = sums.select("tree", *values, (F.col("total") / F.col("weight")).alias(label),
                       F.col("weight").alias("_ff_weight"))
    subset = learner.getFeatureSubsetStrategy()
    if subset == "auto":  # what it means for so many trees
        subset = "all" if n == 1 else "onethird"
    with staged(spark, bags, "bags") as few:
        def tree(t: int) -> RandomForestRegressionModel:
            one = regressor("rf", label, **{
                **params, "numTrees": 1, "bootstrap": False, "featureSubsetStrategy": subset,
                "seed": seed + t, "weightCol": "_ff_weight"})
            # Bounded by the cells, not the rows.
            return one.fit(vector.transform(few.where(F.col("tree") == t).coalesce(1)))

        with ThreadPool(min(n, _TREES_AT_ONCE)) as pool:
            grown = pool.map(inheritable_thread_target(spark)(tree), range(n))
    return _forest(spark, learner, grown)


def _forest(spark: SparkSession, learner: RandomForestRegressor,
            grown: Sequence[RandomForestRegressionModel]) -> RandomForestRegressionModel:
    """One model of all trees of the given ones (Spark ML has no call for it in Python)."""
    ml = spark.sparkContext._jvm.org.apache.spark.ml.regression
    trees = [t._java_obj for m in grown for t in m.trees]
    array = spark.sparkContext._gateway.new_array(ml.DecisionTreeRegressionModel, len(trees))
    for i, t in enumerate(trees):
        array[i] = t
    made = ml.RandomForestRegressionModel(learner.uid, array, grown[0].numFeatures)
    model = learner._copyValues(RandomForestRegressionModel(made))
    model._transfer_params_to_java()  # or it would claim the default number of trees
    return model


def _dealt(rows: DataFrame, n: int, features: int, trees: int) -> DataFrame:
    """Training rows in partitions that stay small where a learner keeps them:
    some 250 bytes a row, 8 a feature and 4 a tree (its bagging weight)."""
    parts = math.ceil(n * (250 + 8 * features + 4 * trees) / _KEPT_BYTES)
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def fit_pipeline(train: DataFrame, feature_cols: Sequence[str], label: str,
                 kind: str = "dt", impute: bool = False, **params) -> PipelineModel:
    """Assembler + regressor, fit on the cluster.

    The training columns are staged once on shared storage for the length of
    the fit, so a joined frame is not evaluated again by every stage and
    iteration.  ``impute=True`` puts a mean ``Imputer`` in front, so rows whose
    looked-up features are missing count too; the means are learnt from
    ``train`` and saved with the pipeline.  Otherwise rows with a null or NaN
    feature are left out; the model's ``rows_used`` and ``rows_dropped`` say how
    many.

    Trees on few features, whose bins make far fewer cells than there are rows,
    are fit on the cells (:func:`_fit_cells`): the rows are then read a few times,
    not once per level of every round or forest.
    """
    names = list(feature_cols)
    feats = names
    stages = []
    if impute:
        cast, filled = _helpers(len(names))
        sql = SQLTransformer(statement="SELECT *, " + ", ".join(
            f"CAST(`{c}` AS DOUBLE) AS `{h}`" for c, h in zip(names, cast)) + " FROM __THIS__")
        stages += [sql, Imputer(inputCols=cast, outputCols=filled, strategy="mean")]
        feats = filled
    learner = regressor(kind, label, **params)
    stages += [assembler(feats), learner]
    needed = train.select(*dict.fromkeys([*names, label])).where(F.col(label).isNotNull())
    with staged(train.sparkSession, spread(needed), "training") as rows:
        n = rows.agg(F.count(F.lit(1)).alias("all"), F.count_if(_valid(names)).alias("ok")).first()
        cuts = model = None
        settings = _FOREST_PARAMS if kind == "rf" else _CELL_PARAMS
        if not impute and params.keys() <= settings and (
                kind in ("dt", "rf") or learner.getLossType() == "squared") and all(
                isinstance(rows.schema[c].dataType, NumericType) for c in names):
            gain, found = _FOREST_GAIN if kind == "rf" else _CELL_GAIN, []
            # Without the check a scan for one feature reads that one only.
            valid = rows if n["ok"] == n["all"] else rows.where(_valid(names))
            cuts = _few_cells(valid, names, n["ok"], learner.getMaxBins(), gain, found)
            if cuts is None and kind in ("gbt", "gbt_default") and n["ok"] >= _GROWN_ROWS:
                model = _fit_grown(valid, names, label, learner, found)
        if cuts is not None:
            model = _fit_cells(rows, names, label, kind, cuts, params)
        elif model is None:
            trees = learner.getNumTrees() if kind == "rf" else 1
            model = Pipeline(stages=stages).fit(_dealt(rows, n["all"], len(names), trees))
    model.rows_used = n["all"] if impute else n["ok"]
    model.rows_dropped = n["all"] - model.rows_used
    return model


def _valid(cols: Sequence[str]) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(f"`{c}`").isNotNull() & ~F.isnan(F.col(f"`{c}`").cast("double"))
    return ok


# -------------------------------------------------------------- evaluation
def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction",
                       group_cols: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE, R2 (``1 - SSE / SST``) in a single aggregation pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    err = y - p
    src = pred.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    agg = src.groupBy(*group_cols).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("mse"),
        F.sum(err * err).alias("_sse"),
        F.var_pop(y).alias("_var"),
    )
    return agg.select(
        *group_cols, "n", "mae", "mse", F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.col("_sse") / F.nullif(F.col("_var") * F.col("n"), F.lit(0.0)))
        .alias("r2"),
    )


# ---------------------------------------------------- save / load / score
_SPEC = "feature_spec.json"


def save_model(model: PipelineModel, path: str, training_set: TrainingSet | None = None,
               feature_cols: Sequence[str] | None = None) -> str:
    """Save the pipeline and, beside it, the lookup spec and feature order."""
    model.write().overwrite().save(f"{path}/model")
    spec = json.loads(training_set.spec_json()) if training_set is not None else {}
    spec["feature_cols"] = list(feature_cols or [])
    spark = SparkSession.getActiveSession()
    # One small JSON document, written through Spark so it lands on shared storage.
    spark.createDataFrame([(json.dumps(spec),)], "spec string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/{_SPEC}")
    return path


def load_spec(spark: SparkSession, path: str) -> dict:
    rows = spark.read.text(f"{path}/{_SPEC}").collect()
    return json.loads(rows[0][0]) if rows else {}


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(f"{path}/model" if not path.endswith("/model") else path)


def score_batch(spark: SparkSession, model_path: str, df: DataFrame,
                keep_vector: bool = False) -> DataFrame:
    """Look up the model's features for ``df`` and append ``prediction``.

    Output: the input columns, the looked-up features and ``prediction``, one
    row per input row.  A row with a missing feature is scored with the imputed
    one if the model imputes; otherwise its prediction is null.
    """
    spec = load_spec(spark, model_path)
    lookups = [FeatureLookup.from_dict(d) for d in spec.get("feature_lookups", [])]
    joined = apply_lookups(spark, df, lookups)
    model = load_model(model_path)
    for s in model.stages:
        if isinstance(s, (VectorAssembler, Bucketizer)):
            s.setHandleInvalid("keep")
    out = model.transform(joined)
    feats = spec.get("feature_cols") or []
    if any(isinstance(s, ImputerModel) for s in model.stages):
        out = out.drop(*[h for names in _helpers(len(feats)) for h in names])
    else:
        used = feats or next(s for s in model.stages
                             if isinstance(s, (Bucketizer, VectorAssembler))).getInputCols()
        out = out.withColumn("prediction", F.when(_valid(used), F.col("prediction")))
    return out if keep_vector else out.drop(FEATURES_COL)


def model_dir(spark: SparkSession, name: str) -> str:
    from featflow.session import fresh_path
    return fresh_path(spark, "model", name)


