"""Model queries: splits, evaluation, training, batch scoring and tree SHAP."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featflow.operators.lookup import create_training_set
from featflow.operators.models import (
    FEATURES_COL,
    fit_pipeline,
    label_split,
    load_model,
    model_dir,
    regression_metrics,
    save_model,
    score_batch,
    split_by_hash,
    split_exact,
)
from featflow.operators.treeshap import (
    Ensemble,
    Tree,
    ensemble_from_spark,
    shap_ranked,
    shap_summary,
    shap_values,
)
from featflow.operators.treeshap_sql import shap_values_sql
from featflow.plans.fixtures import (
    TRIPS_SQL,
    WINE_FEATURES,
    WINE_ID,
    WINE_LABEL,
    regression_table,
    table,
    trips,
)
from featflow.plans.taxi import (
    CUT,
    DROPOFF_SQL,
    EXCLUDE,
    ROUNDED_SQL,
    build_feature_tables,
    lookups,
    pickup_sql,
    rounded_taxi_data,
)

# ------------------------------------------------------------------ splits
def q_split_hash(spark, sf_dir):
    return label_split(regression_table(spark, sf_dir), WINE_ID, 0.7, 42) \
        .select(*WINE_ID, "split")


def q_split_random(spark, sf_dir):
    """A second, differently seeded split (70/30)."""
    return label_split(regression_table(spark, sf_dir), WINE_ID, 0.7, 7).select(*WINE_ID, "split")


def q_split_exact(spark, sf_dir):
    """Exactly a quarter of all rows (rounded up) on the test side."""
    return split_exact(regression_table(spark, sf_dir), WINE_ID, 0.25, 42).select(*WINE_ID, "split")


def q_split_counts(spark, sf_dir):
    """Row counts of both sides of the split."""
    split = label_split(regression_table(spark, sf_dir), WINE_ID, 0.7, 42)
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------- evaluation
def _fixed_score(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", F.col("l_quantity") * F.lit(1500.0))


def q_eval_metrics(spark, sf_dir):
    li = _fixed_score(table(spark, sf_dir, "lineitem"))
    m = regression_metrics(li, WINE_LABEL, "prediction", ["l_returnflag", "l_linestatus"])
    return m.select("l_returnflag", "l_linestatus", "n", F.round("mae", 6).alias("mae"),
                    F.round("mse", 2).alias("mse"), F.round("rmse", 6).alias("rmse"),
                    F.round("r2", 9).alias("r2"))


def _train_eval(kind: str):
    def q(spark, sf_dir):
        data = regression_table(spark, sf_dir)
        checks, model = _model_checks(spark, data, WINE_FEATURES, WINE_LABEL, WINE_ID, kind)
        _, test = split_by_hash(data, WINE_ID, 0.7, 42)
        m = regression_metrics(model.transform(test), WINE_LABEL)
        m = m.select(F.lit(kind).alias("model"), "n", F.round("mae", 4).alias("mae"),
                     F.round("mse", 0).alias("mse"), F.round("rmse", 4).alias("rmse"),
                     F.round("r2", 7).alias("r2"))
        return checks.crossJoin(F.broadcast(m))  # one row of metrics
    q.__name__ = f"q_{kind}_train_eval"
    q.__doc__ = """Every row scored, explained and scored again by the saved copy of a model
    fit on the train side, beside the model's errors and R2 on the test side."""
    return q


def _close(a, b):
    return F.abs(F.col(a) - F.col(b)) <= 1e-6 * F.greatest(F.lit(1.0), F.abs(F.col(b)))


def _model_checks(spark, data: DataFrame, features, label, ids, kind: str,
                  **params) -> tuple[DataFrame, PipelineModel]:
    """Fit on the train side, score and explain every row; (checks, model).

    Per row: the ids, the split side, and whether the model's prediction equals
    the combination of its trees (``trees_ok``), base value plus shares
    (``shap_ok``) and the prediction of the model saved and loaded again
    (``reload_ok``).
    """
    train, _ = split_by_hash(data, ids, 0.7, 42)
    model = fit_pipeline(train, features, label, kind, **params)
    again = load_model(save_model(model, model_dir(spark, kind), None, features))
    ens = ensemble_from_spark(spark, again, features)
    side = label_split(data, ids, 0.7, 42)
    scored = model.transform(side).drop(FEATURES_COL).withColumnRenamed("prediction", "fitted")
    scored = again.transform(scored).drop(FEATURES_COL)
    out = shap_values(scored, ens, features, [*ids, "split", "fitted", "prediction"],
                      dtype="double", prefix="phi_", prediction_col="trees")
    total = F.col("expected_value")
    for f in features:
        total = total + F.col(f"phi_{f}")
    out = out.withColumn("total", total)
    return out.select(*ids, "split", _close("trees", "fitted").alias("trees_ok"),
                      _close("total", "fitted").alias("shap_ok"),
                      (F.col("prediction") == F.col("fitted")).alias("reload_ok")), model


def _checks(kind: str, **params):
    def q(spark, sf_dir):
        return _model_checks(spark, regression_table(spark, sf_dir), WINE_FEATURES, WINE_LABEL,
                             WINE_ID, kind, **params)[0]
    q.__name__ = f"q_{kind}_checks"
    return q


# A dozen features: four measures and eight small ones from the keys.
WIDE_FEATURES = ("l_quantity", "l_discount", "l_tax", "l_extendedprice",
                 *[f"k{i}" for i in range(8)])


def wide_table(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    keys = [F.pmod(F.col(c), F.lit(m)).cast("double").alias(f"k{i}") for i, (c, m) in enumerate(
        (c, m) for c in ("l_partkey", "l_suppkey") for m in (3, 7, 11, 13))]
    base = li.select(*WINE_ID, *WIDE_FEATURES[:4], *keys)
    y = F.col("l_extendedprice") * (1 - F.col("l_discount")) + 500 * F.col("k1") - 90 * F.col("k6")
    return base.withColumn("y", y + F.col("k0") * F.col("l_quantity"))


def q_tree_shap_wide(spark, sf_dir):
    """Boosted model over twelve features, every row explained."""
    return _model_checks(spark, wide_table(spark, sf_dir), WIDE_FEATURES, "y", WINE_ID, "gbt",
                         maxIter=20, maxDepth=5)[0]


# ------------------------------------------------------------ batch scoring
_SCORE_COLS = ["fare_amount", "trip_distance", "pickup_zip", "dropoff_zip",
               "rounded_pickup_datetime", "rounded_dropoff_datetime",
               "mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip",
               "count_trips_window_30m_dropoff_zip", "dropoff_is_weekend"]


def _report(scored: DataFrame) -> DataFrame:
    """Scored rows with the prediction first, renamed and rounded to cents."""
    return scored.select("prediction", *_SCORE_COLS) \
        .withColumnRenamed("prediction", "predicted_fare_amount") \
        .withColumn("predicted_fare_amount", F.round("predicted_fare_amount", 2))


def q_score_batch(spark, sf_dir):
    """Train on a 75/25 key-hash split of the training set, score every trip."""
    pn, dn = build_feature_tables(spark, sf_dir)
    base = rounded_taxi_data(trips(spark, sf_dir))
    train_base, _ = split_by_hash(base, ["trip_id"], 0.75, 123)
    ts = create_training_set(spark, train_base, lookups(pn, dn), label="fare_amount",
                             exclude_columns=[*EXCLUDE, "trip_id"])
    train = ts.load_df()
    feats = [c for c in train.columns if c != "fare_amount"]
    model = fit_pipeline(train, feats, "fare_amount", "gbt", impute=True, maxIter=100, maxDepth=5)
    path = save_model(model, model_dir(spark, "taxi_fare"), ts, feats)
    scored = score_batch(spark, path, base)
    return scored.select(*_SCORE_COLS, F.round("prediction", 6).alias("prediction")).withColumn(
        "mean_fare_window_1h_pickup_zip", F.col("mean_fare_window_1h_pickup_zip").cast("double"))


def q_score_report(spark, sf_dir):
    """Same shape as ``score_batch`` with a fixed linear score (SQL-checkable)."""
    pn, dn = build_feature_tables(spark, sf_dir)
    base = rounded_taxi_data(trips(spark, sf_dir))
    ts = create_training_set(spark, base, lookups(pn, dn), label="fare_amount")
    scored = ts.load_df().withColumn(
        "prediction",
        F.coalesce(F.col("mean_fare_window_1h_pickup_zip").cast("double"), F.lit(0.0))
        * F.lit(1.1) + F.col("trip_distance") * F.lit(0.3713579) + F.lit(0.000123))
    return _report(scored).withColumn(
        "mean_fare_window_1h_pickup_zip", F.col("mean_fare_window_1h_pickup_zip").cast("double"))


# --------------------------------------------------------------- tree SHAP
# The structure of the literal two-level tree (feature order:
# l_extendedprice, l_discount, l_tax); label l_quantity.
FIXED_FEATURES = ("l_extendedprice", "l_discount", "l_tax")
FIXED_LABEL = "l_quantity"
PRICE_SPLIT, DISCOUNT_SPLIT, PRICE_SPLIT_2 = 40000.0, 0.05, 70000.0


def fixed_tree_ensemble(df: DataFrame) -> Ensemble:
    """The fixed structure with covers and leaf means measured on ``df`` by Spark."""
    p, d = F.col("l_extendedprice"), F.col("l_discount")
    leaf = (F.when(p <= PRICE_SPLIT, F.when(d <= DISCOUNT_SPLIT, 3).otherwise(4))
            .otherwise(F.when(p <= PRICE_SPLIT_2, 5).otherwise(6)))
    stats = {r["leaf"]: (float(r["n"]), float(r["s"])) for r in
             df.groupBy(leaf.alias("leaf"))
             .agg(F.count(F.lit(1)).alias("n"), F.sum(FIXED_LABEL).alias("s")).collect()}
    n = {k: stats.get(k, (0.0, 0.0))[0] for k in (3, 4, 5, 6)}
    v = {k: (stats[k][1] / stats[k][0] if n[k] else 0.0) for k in (3, 4, 5, 6)}
    n[1], n[2] = n[3] + n[4], n[5] + n[6]
    n[0] = n[1] + n[2]

    def mean(*ks):
        tot = sum(n[k] for k in ks)
        return sum(v[k] * n[k] for k in ks) / tot if tot else 0.0
    nodes = [
        {"id": 0, "feature": 0, "threshold": PRICE_SPLIT, "left": 1, "right": 2,
         "value": mean(3, 4, 5, 6), "cover": n[0]},
        {"id": 1, "feature": 1, "threshold": DISCOUNT_SPLIT, "left": 3, "right": 4,
         "value": mean(3, 4), "cover": n[1]},
        {"id": 2, "feature": 0, "threshold": PRICE_SPLIT_2, "left": 5, "right": 6,
         "value": mean(5, 6), "cover": n[2]},
    ] + [{"id": k, "feature": -1, "threshold": 0.0, "left": -1, "right": -1,
          "value": v[k], "cover": n[k]} for k in (3, 4, 5, 6)]
    return Ensemble([Tree.from_nodes(nodes)], [1.0], list(FIXED_FEATURES))


def _fixed_model(spark, sf_dir) -> tuple[DataFrame, Ensemble]:
    li = table(spark, sf_dir, "lineitem")
    ok = F.lit(True)
    for c in FIXED_FEATURES:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    return li, fixed_tree_ensemble(li.where(ok))


def _fixed_shap(spark, sf_dir) -> DataFrame:
    li, ens = _fixed_model(spark, sf_dir)
    return shap_values(li, ens, FIXED_FEATURES, WINE_ID, dtype="double")


def _round6(df: DataFrame, cols) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


def q_tree_shap_fixed(spark, sf_dir):
    return _round6(_fixed_shap(spark, sf_dir), {"expected_value", *FIXED_FEATURES})


def q_tree_shap_sql(spark, sf_dir):
    """The same shares by a join with the share table, without Python."""
    out = shap_values_sql(*_fixed_model(spark, sf_dir), FIXED_FEATURES, WINE_ID)
    return _round6(out, {"expected_value", *FIXED_FEATURES})


def q_shap_summary(spark, sf_dir):
    s = shap_summary(_fixed_shap(spark, sf_dir), FIXED_FEATURES)
    q = F.transform("abs_quartiles", lambda x: F.round(x, 6)).alias("abs_quartiles")
    return _round6(s, {"mean_abs_shap", "mean_shap"}).select(
        "feature", "rank", "mean_abs_shap", "mean_shap", q)


def q_shap_local(spark, sf_dir):
    """Per row and feature: base value, rank and share."""
    r = shap_ranked(_fixed_shap(spark, sf_dir), FIXED_FEATURES, WINE_ID)
    return _round6(r, {"phi", "expected_value"})


QUERIES = {
    "split_hash": q_split_hash,
    "split_random": q_split_random,
    "split_exact": q_split_exact,
    "split_counts": q_split_counts,
    "eval_mae_mse_rmse_r2": q_eval_metrics,
    "rf_train_eval": _train_eval("rf"),
    "gbt_train_eval": _train_eval("gbt"),
    "gbt_default_eval": _train_eval("gbt_default"),
    "score_batch": q_score_batch,
    "score_report": q_score_report,
    "tree_shap_fixed": q_tree_shap_fixed,
    "tree_shap_sql": q_tree_shap_sql,
    "tree_shap_model": _checks("dt"),
    "tree_shap_forest": _checks("rf"),
    "tree_shap_boosted": _checks("gbt"),
    "tree_shap_wide": q_tree_shap_wide,
    "shap_summary": q_shap_summary,
    "shap_local": q_shap_local,
}

# ------------------------------------------------------------ DuckDB twins
_FIXED = f"""
li AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice AS p, l_discount AS d, l_tax AS t,
         l_quantity AS y
  FROM lineitem
  WHERE l_extendedprice IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL
    AND NOT isnan(l_extendedprice) AND NOT isnan(l_discount) AND NOT isnan(l_tax)
),
lf AS (
  SELECT *, CASE WHEN p <= {PRICE_SPLIT} THEN (CASE WHEN d <= {DISCOUNT_SPLIT} THEN 3 ELSE 4 END)
                 ELSE (CASE WHEN p <= {PRICE_SPLIT_2} THEN 5 ELSE 6 END) END AS leaf
  FROM li
),
st AS (
  SELECT CAST(count(*) FILTER (WHERE leaf = 3) AS DOUBLE) AS n3,
         CAST(count(*) FILTER (WHERE leaf = 4) AS DOUBLE) AS n4,
         CAST(count(*) FILTER (WHERE leaf = 5) AS DOUBLE) AS n5,
         CAST(count(*) FILTER (WHERE leaf = 6) AS DOUBLE) AS n6,
         sum(y) FILTER (WHERE leaf = 3) AS s3, sum(y) FILTER (WHERE leaf = 4) AS s4,
         sum(y) FILTER (WHERE leaf = 5) AS s5, sum(y) FILTER (WHERE leaf = 6) AS s6
  FROM lf
),
c AS (
  SELECT n3, n4, n5, n6, n3 + n4 AS n1, n5 + n6 AS n2, n3 + n4 + n5 + n6 AS n,
         coalesce(s3 / NULLIF(n3, 0), 0) AS v3, coalesce(s4 / NULLIF(n4, 0), 0) AS v4,
         coalesce(s5 / NULLIF(n5, 0), 0) AS v5, coalesce(s6 / NULLIF(n6, 0), 0) AS v6
  FROM st
),
z AS (
  SELECT *, n1 / n AS zp, n3 / n1 AS zd3, n4 / n1 AS zd4,
         (n2 / n) * (n5 / n2) AS z5, (n2 / n) * (n6 / n2) AS z6 FROM c
),
phi AS (
  SELECT l_orderkey, l_linenumber,
         v3 * zp * zd3 + v4 * zp * zd4 + v5 * z5 + v6 * z6 AS expected_value,
         v3 * (CAST(p <= {PRICE_SPLIT} AS DOUBLE) - zp) * (zd3 + CAST(d <= {DISCOUNT_SPLIT} AS DOUBLE)) / 2
       + v4 * (CAST(p <= {PRICE_SPLIT} AS DOUBLE) - zp) * (zd4 + CAST(d > {DISCOUNT_SPLIT} AS DOUBLE)) / 2
       + v5 * (CAST(p > {PRICE_SPLIT} AND p <= {PRICE_SPLIT_2} AS DOUBLE) - z5)
       + v6 * (CAST(p > {PRICE_SPLIT_2} AS DOUBLE) - z6) AS l_extendedprice,
         v3 * (CAST(d <= {DISCOUNT_SPLIT} AS DOUBLE) - zd3) * (zp + CAST(p <= {PRICE_SPLIT} AS DOUBLE)) / 2
       + v4 * (CAST(d > {DISCOUNT_SPLIT} AS DOUBLE) - zd4) * (zp + CAST(p <= {PRICE_SPLIT} AS DOUBLE)) / 2
           AS l_discount,
         CAST(0.0 AS DOUBLE) AS l_tax
  FROM lf, z
)"""

def _split_sql(seed: int = 42) -> str:
    h = (f"('0x' || substr(md5('{seed}:' || CAST(l_orderkey AS VARCHAR) || ':' || "
         "CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0::DOUBLE")
    return f"CASE WHEN {h} < 0.7 THEN 'train' ELSE 'test' END"


_CHECKS_SQL = f"""SELECT l_orderkey, l_linenumber, {_split_sql()} AS split,
    true AS trees_ok, true AS shap_ok, true AS reload_ok FROM lineitem"""

def _per_row_rank_sql(feats) -> str:
    """Rank of each feature by |phi| inside its own row (ties by name), unpivoted."""
    parts = []
    for f in feats:
        beats = " + ".join(
            f"CAST(abs({g}) > abs({f}) OR (abs({g}) = abs({f}) AND '{g}' < '{f}') AS INTEGER)"
            for g in feats if g != f)
        parts.append(f"SELECT l_orderkey, l_linenumber, CAST(1 + {beats} AS INTEGER) AS rank, "
                     f"'{f}' AS feature, round({f}, 6) AS phi, "
                     "round(expected_value, 6) AS expected_value FROM phi")
    return "ranked AS (" + " UNION ALL ".join(parts) + ") SELECT * FROM ranked"


_SCORE_EXPR = """round(coalesce(CAST(p.mean_fare_window_1h_pickup_zip AS DOUBLE), 0.0) * 1.1
                 + r.trip_distance * 0.3713579 + 0.000123, 2) AS predicted_fare_amount"""
_SCORE_REPORT = f"""WITH {TRIPS_SQL}, {ROUNDED_SQL}, {pickup_sql(None, CUT)}, {DROPOFF_SQL}
    SELECT {_SCORE_EXPR},
           r.fare_amount, r.trip_distance, r.pickup_zip, r.dropoff_zip,
           r.rounded_pickup_datetime, r.rounded_dropoff_datetime,
           CAST(p.mean_fare_window_1h_pickup_zip AS DOUBLE) AS mean_fare_window_1h_pickup_zip,
           p.count_trips_window_1h_pickup_zip, d.count_trips_window_30m_dropoff_zip,
           d.dropoff_is_weekend
    FROM rounded r
    LEFT JOIN pick p ON p.zip = r.pickup_zip AND p.ts = r.rounded_pickup_datetime
    LEFT JOIN dropf d ON d.zip = r.dropoff_zip AND d.ts = r.rounded_dropoff_datetime"""

_FIXED_SHAP_SQL = f"""WITH {_FIXED}
  SELECT l_orderkey, l_linenumber, round(expected_value, 6) AS expected_value,
         round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount,
         round(l_tax, 6) AS l_tax FROM phi"""

SQL = {
    "score_report": _SCORE_REPORT,
    "split_hash": f"SELECT l_orderkey, l_linenumber, {_split_sql()} AS split FROM lineitem",
    "split_random": f"SELECT l_orderkey, l_linenumber, {_split_sql(7)} AS split FROM lineitem",
    "split_exact": """
        SELECT l_orderkey, l_linenumber, CASE WHEN row_number() OVER (ORDER BY h)
                 <= ceil(count(*) OVER () * 0.25) THEN 'test' ELSE 'train' END AS split
        FROM (SELECT *, substr(md5('42:' || CAST(l_orderkey AS VARCHAR) || ':' ||
                                   CAST(l_linenumber AS VARCHAR)), 1, 15) AS h FROM lineitem)""",
    "split_counts": f"SELECT {_split_sql()} AS split, count(*) AS n FROM lineitem GROUP BY 1",
    **{name: _CHECKS_SQL for name in (
        "tree_shap_model", "tree_shap_forest", "tree_shap_boosted", "tree_shap_wide")},
    "eval_mae_mse_rmse_r2": """
        WITH s AS (SELECT l_returnflag, l_linestatus, l_extendedprice AS y,
                          l_quantity * 1500.0 AS p FROM lineitem
                   WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL)
        SELECT l_returnflag, l_linestatus, count(*) AS n,
               round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 2) AS mse,
               round(sqrt(avg((y - p) * (y - p))), 6) AS rmse,
               round(1 - sum((y - p) * (y - p)) / NULLIF(var_pop(y) * count(*), 0), 9) AS r2
        FROM s GROUP BY l_returnflag, l_linestatus""",
    "tree_shap_fixed": _FIXED_SHAP_SQL,
    "tree_shap_sql": _FIXED_SHAP_SQL,
    "shap_summary": f"""WITH {_FIXED},
        long AS (SELECT 'l_extendedprice' AS feature, l_extendedprice AS phi FROM phi
                 UNION ALL SELECT 'l_discount', l_discount FROM phi
                 UNION ALL SELECT 'l_tax', l_tax FROM phi),
        g AS (SELECT feature, avg(abs(phi)) AS m, round(avg(phi), 6) AS mean_shap,
                     quantile_cont(abs(phi), [0.25, 0.5, 0.75]) AS q FROM long GROUP BY feature)
        SELECT feature, CAST(row_number() OVER (ORDER BY m DESC, feature) AS INTEGER) AS rank,
               round(m, 6) AS mean_abs_shap, mean_shap,
               list_transform(q, lambda x: round(x, 6)) AS abs_quartiles FROM g""",
    "shap_local": f"""WITH {_FIXED}, {_per_row_rank_sql(FIXED_FEATURES)}""",
}
