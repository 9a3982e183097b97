"""Queries of the histogram learners, each with a DuckDB twin that learns the same
trees from the same binned rows and predicts every row."""

from __future__ import annotations

from pyspark.sql import functions as F

from featflow.operators.hist_trees import POISSON, fit_boosted, fit_forest, fit_tree
from featflow.operators.lookup import create_training_set
from featflow.operators.models import (
    label_split,
    model_dir,
    regression_metrics,
    save_model,
    score_batch,
    split_by_hash,
)
from featflow.operators.treeshap import shap_values
from featflow.plans.fixtures import (
    TRIPS_SQL,
    WINE_FEATURES,
    WINE_ID,
    WINE_LABEL,
    regression_table,
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

#: Cuts of the three features, between their values.
EDGES = ([5.5 + 5 * i for i in range(9)], [0.005 + 0.01 * i for i in range(10)],
         [0.005 + 0.01 * i for i in range(8)])
SCALE = 1024.0
ROUNDS, LEAVES, MIN_LEAF = 3, 4, 20
TREES, DEPTH, SUBSET, SEED = 5, 3, 2, 42


def _split(spark, sf_dir):
    return split_by_hash(regression_table(spark, sf_dir), WINE_ID, 0.7, 42)


def _predicted(spark, sf_dir, model):
    rows = label_split(regression_table(spark, sf_dir), WINE_ID, 0.7, 42)
    return model.predict(rows).select(*WINE_ID, "split", F.round("prediction", 6).alias("prediction"))


def _boosted(spark, sf_dir):
    return fit_boosted(_split(spark, sf_dir)[0], WINE_FEATURES, WINE_LABEL, ROUNDS, LEAVES, 0.1,
                       min_leaf=MIN_LEAF, edges=EDGES, scale=SCALE, stage_rounds=2)


def q_boost_leafwise(spark, sf_dir):
    """Leaf-wise boosting, fit on the train side; every row's prediction."""
    return _predicted(spark, sf_dir, _boosted(spark, sf_dir))


def q_boost_leafwise_shap(spark, sf_dir):
    """The same model's base value plus shares of every row."""
    model = _boosted(spark, sf_dir)
    rows = label_split(regression_table(spark, sf_dir), WINE_ID, 0.7, 42)
    out = shap_values(rows, model.ensemble(), WINE_FEATURES, [*WINE_ID, "split"], dtype="double",
                      prefix="phi_")
    total = F.col("expected_value")
    for f in WINE_FEATURES:
        total = total + F.col(f"phi_{f}")
    return out.select(*WINE_ID, "split", F.round(total, 4).alias("prediction"))


def q_forest_bagged(spark, sf_dir):
    """Forest with hashed bagging and feature subsets; every row's prediction."""
    return _predicted(spark, sf_dir, fit_forest(
        _split(spark, sf_dir)[0], WINE_FEATURES, WINE_LABEL, WINE_ID, TREES, DEPTH, SUBSET,
        seed=SEED, edges=EDGES, scale=SCALE))


def q_dt_train_eval(spark, sf_dir):
    """Tree of depth 5 on three features, fit on the train side, its errors and R2
    on the test side."""
    train, test = _split(spark, sf_dir)
    model = fit_tree(train, WINE_FEATURES, WINE_LABEL, depth=5, edges=EDGES, scale=SCALE)
    m = regression_metrics(model.predict(test), WINE_LABEL)
    return m.select(F.lit("dt").alias("model"), "n", F.round("mae", 4).alias("mae"),
                    F.round("mse", 0).alias("mse"), F.round("rmse", 4).alias("rmse"),
                    F.round("r2", 7).alias("r2"))


#: Features of the scored trips and their cuts.
SCORE_FEATURES = ("trip_distance", "mean_fare_window_1h_pickup_zip",
                  "count_trips_window_1h_pickup_zip", "count_trips_window_30m_dropoff_zip",
                  "dropoff_is_weekend")
SCORE_EDGES = ([2.05 + 2 * i for i in range(9)], [50.0 * i for i in range(1, 10)],
               [1.5 + i for i in range(8)], [1.5 + i for i in range(8)], [0.5])
SCORE_COLS = ["fare_amount", "trip_distance", "pickup_zip", "dropoff_zip",
              "rounded_pickup_datetime", "rounded_dropoff_datetime",
              "mean_fare_window_1h_pickup_zip", "count_trips_window_1h_pickup_zip",
              "count_trips_window_30m_dropoff_zip", "dropoff_is_weekend"]


def q_score_batch_leafwise(spark, sf_dir):
    """Leaf-wise boosting on the train side of the training set, saved with its
    lookups, loaded and applied to every trip; null where a feature is missing."""
    pn, dn = build_feature_tables(spark, sf_dir)
    base = rounded_taxi_data(trips(spark, sf_dir))
    train_base, _ = split_by_hash(base, ["trip_id"], 0.75, 123)
    ts = create_training_set(spark, train_base, lookups(pn, dn), label="fare_amount",
                             exclude_columns=[*EXCLUDE, "trip_id"])
    model = fit_boosted(ts.load_df(), SCORE_FEATURES, "fare_amount", ROUNDS, LEAVES, 0.1,
                        min_leaf=MIN_LEAF, edges=SCORE_EDGES, scale=SCALE)
    path = save_model(model.pipeline(), model_dir(spark, "taxi_leafwise"), ts, SCORE_FEATURES)
    scored = score_batch(spark, path, base)
    return scored.select(*SCORE_COLS, F.round("prediction", 6).alias("prediction")).withColumn(
        "mean_fare_window_1h_pickup_zip", F.col("mean_fare_window_1h_pickup_zip").cast("double"))


QUERIES = {
    "score_batch_leafwise": q_score_batch_leafwise,
    "boost_leafwise": q_boost_leafwise,
    "boost_leafwise_shap": q_boost_leafwise_shap,
    "forest_bagged": q_forest_bagged,
    "dt_train_eval": q_dt_train_eval,
}


# ------------------------------------------------------------ DuckDB twins
def _hash(seed: str) -> str:
    return (f"('0x' || substr(md5({seed} || ':' || CAST(l_orderkey AS VARCHAR) || ':' || "
            "CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0::DOUBLE")


def _bins(features, all_edges) -> str:
    return ", ".join("(" + " + ".join(f"(CASE WHEN {c} > {float(e)!r}::DOUBLE THEN 1 ELSE 0 END)"
                                      for e in edges) + f") AS b{i}"
                     for i, (c, edges) in enumerate(zip(features, all_edges)))


def _rows() -> str:
    bins = _bins(WINE_FEATURES, EDGES)
    return (f"s AS (SELECT row_number() OVER () AS rid, l_orderkey, l_linenumber, {_hash(repr('42'))} < 0.7 AS train, "
            f"{WINE_LABEL}::DOUBLE AS y, {bins} FROM lineitem)")


def _feats(edges) -> str:
    return "(VALUES " + ", ".join(f"({i})" for i in range(len(edges))) + ") AS fs(feat)"


def _bin_of(edges, feat: str = "feat") -> str:
    return f"CASE {feat} " + " ".join(f"WHEN {i} THEN b{i}" for i in range(len(edges))) + " END"


def _cuts(edges) -> str:
    return "CASE feat " + " ".join(f"WHEN {i} THEN {len(e)}" for i, e in enumerate(edges)) + " END"


_GAIN = ("lg * lg / lw + (tg - lg) * (tg - lg) / (tw - lw) - tg * tg / tw")


def _cumulated(source: str, node: str, edges=EDGES) -> str:
    """Sums left of each cut and of the whole node, as doubles."""
    return f"""SELECT *, {_GAIN} AS gain FROM (
      SELECT {node}, feat, bin, sum(w) OVER c::DOUBLE AS lw, sum(g) OVER c::DOUBLE AS lg,
             sum(w) OVER t::DOUBLE AS tw, sum(g) OVER t::DOUBLE AS tg
      FROM (SELECT {node}, feat, {_bin_of(edges)} AS bin, sum(w) AS w, sum(g) AS g
            FROM {source}, {_feats(edges)} WHERE train AND w > 0 GROUP BY ALL)
      WINDOW c AS (PARTITION BY {node}, feat ORDER BY bin),
             t AS (PARTITION BY {node}, feat))"""


def _boost_ctes(rows: list[str], edges) -> str:
    """CTEs up to ``r<ROUNDS>``: the rows of ``s`` with their prediction ``f``."""
    ctes = [*rows, f"""base AS (SELECT sum(floor(y * {SCALE} + 0.5)::BIGINT)::DOUBLE / count(*) / {SCALE}
            AS f FROM s WHERE train)""", "r0 AS (SELECT s.*, base.f, 1 AS w FROM s, base)"]
    for k in range(ROUNDS):
        ctes.append(f"""a{k}_0 AS MATERIALIZED (
          SELECT *, floor((y - f) * {SCALE} + 0.5)::BIGINT AS g, 0 AS leaf FROM r{k})""")
        for j in range(1, LEAVES):
            ctes.append(f"""best{k}_{j} AS MATERIALIZED (
              SELECT * FROM ({_cumulated(f"a{k}_{j - 1}", "leaf", edges)})
              WHERE lw >= {MIN_LEAF} AND tw - lw >= {MIN_LEAF} AND gain > 0 AND bin < {_cuts(edges)}
              ORDER BY gain DESC, leaf, feat, bin LIMIT 1)""")
            ctes.append(f"""a{k}_{j} AS MATERIALIZED (
              SELECT a.* REPLACE (CASE WHEN a.leaf = p.leaf AND {_bin_of(edges, 'p.feat')} > p.bin
                                       THEN {j} ELSE a.leaf END AS leaf)
              FROM a{k}_{j - 1} a LEFT JOIN best{k}_{j} p ON true)""")
        last = f"a{k}_{LEAVES - 1}"
        ctes.append(f"""r{k + 1} AS (
          SELECT {last}.* EXCLUDE (g, leaf) REPLACE (f + 0.1::DOUBLE * v AS f)
          FROM {last} JOIN (SELECT leaf AS l, sum(g)::DOUBLE / count(*) / {SCALE} AS v
                            FROM {last} WHERE train GROUP BY leaf) ON leaf = l)""")
    return "WITH " + ",\n".join(ctes)


def _boost_sql(digits: int) -> str:
    return _boost_ctes([_rows()], EDGES) + f"""
      SELECT l_orderkey, l_linenumber, CASE WHEN train THEN 'train' ELSE 'test' END AS split,
             round(f, {digits}) AS prediction FROM r{ROUNDS}"""


def _score_sql() -> str:
    h = "('0x' || substr(md5('123:' || CAST(trip_id AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0::DOUBLE"
    valid = " AND ".join(f"{c} IS NOT NULL" for c in SCORE_FEATURES)
    rows = [TRIPS_SQL, ROUNDED_SQL, pickup_sql(None, CUT), DROPOFF_SQL, f"""joined AS (
      SELECT r.trip_id, r.fare_amount, r.trip_distance, r.pickup_zip, r.dropoff_zip,
             r.rounded_pickup_datetime, r.rounded_dropoff_datetime,
             CAST(p.mean_fare_window_1h_pickup_zip AS DOUBLE) AS mean_fare_window_1h_pickup_zip,
             p.count_trips_window_1h_pickup_zip, d.count_trips_window_30m_dropoff_zip,
             d.dropoff_is_weekend
      FROM rounded r
      LEFT JOIN pick p ON p.zip = r.pickup_zip AND p.ts = r.rounded_pickup_datetime
      LEFT JOIN dropf d ON d.zip = r.dropoff_zip AND d.ts = r.rounded_dropoff_datetime)""",
            f"""s AS MATERIALIZED (SELECT *, {valid} AS valid, ({valid}) AND {h} < 0.75 AS train,
      fare_amount::DOUBLE AS y, {_bins(SCORE_FEATURES, SCORE_EDGES)} FROM joined)"""]
    return _boost_ctes(rows, SCORE_EDGES) + f"""
      SELECT {", ".join(SCORE_COLS)}, CASE WHEN valid THEN round(f, 6) END AS prediction
      FROM r{ROUNDS}"""


def _forest_ctes(trees: int, depth: int, subset: int, bagging: bool) -> str:
    u = _hash(f"({SEED} * 1000 + tree)::VARCHAR")
    weight = " + ".join(f"(CASE WHEN u >= {p!r}::DOUBLE THEN 1 ELSE 0 END)" for p in POISSON)
    ctes = [_rows().replace('s AS (', 's AS MATERIALIZED (', 1), f"""n0 AS MATERIALIZED (
      SELECT *, floor(y * {SCALE} + 0.5)::BIGINT * w AS g, 1 AS heap FROM (
        SELECT *, {weight if bagging else '1'} AS w FROM (
          SELECT s.*, tree, {u} AS u FROM s, (SELECT unnest(range({trees})) AS tree))))"""]
    for d in range(depth):
        ctes.append(f"""allowed{d} AS (
          SELECT tree AS at_tree, heap AS at_heap, feat AS at_feat
          FROM (SELECT DISTINCT tree, heap FROM n{d}), {_feats(EDGES)}
          QUALIFY row_number() OVER (PARTITION BY tree, heap ORDER BY md5(
            '{SEED}:' || tree || ':' || heap || ':' || feat)) <= {subset})""")
        ctes.append(f"""best{d} AS (
          SELECT tree, heap, feat, bin
          FROM ({_cumulated(f"n{d}", "tree, heap")})
          JOIN allowed{d} ON tree = at_tree AND heap = at_heap AND feat = at_feat
          WHERE tw - lw >= 1 AND gain > 0 AND bin < {_cuts(EDGES)}
          QUALIFY row_number() OVER (PARTITION BY tree, heap ORDER BY gain DESC, feat, bin) = 1)""")
        ctes.append(f"""n{d + 1} AS MATERIALIZED (
          SELECT n.* REPLACE (CASE WHEN p.tree IS NULL THEN n.heap ELSE 2 * n.heap
              + (CASE WHEN {_bin_of(EDGES, 'p.feat')} > p.bin THEN 1 ELSE 0 END) END AS heap)
          FROM n{d} n LEFT JOIN best{d} p ON n.tree = p.tree AND n.heap = p.heap)""")
    total = "0.0::DOUBLE" + "".join(
        f" + {1.0 / trees!r}::DOUBLE * max(v) FILTER (WHERE tree = {t})" for t in range(trees))
    ctes.append(f"""predicted AS (
      SELECT any_value(l_orderkey) AS l_orderkey, any_value(l_linenumber) AS l_linenumber,
             any_value(y) AS y, any_value(train) AS train, {total} AS prediction
      FROM n{depth} JOIN (SELECT tree AS vt, heap AS vh, sum(g)::DOUBLE / sum(w) / {SCALE} AS v
                          FROM n{depth} WHERE train AND w > 0 GROUP BY 1, 2) ON tree = vt AND heap = vh
      GROUP BY rid)""")
    return "WITH " + ",\n".join(ctes)


SQL = {
    "score_batch_leafwise": _score_sql(),
    "boost_leafwise": _boost_sql(6),
    "boost_leafwise_shap": _boost_sql(4),
    "forest_bagged": _forest_ctes(TREES, DEPTH, SUBSET, True) + """
      SELECT l_orderkey, l_linenumber, CASE WHEN train THEN 'train' ELSE 'test' END AS split,
             round(prediction, 6) AS prediction FROM predicted""",
    "dt_train_eval": _forest_ctes(1, 5, 3, False) + """
      SELECT 'dt' AS model, count(*) AS n, round(avg(abs(y - prediction)), 4) AS mae,
             round(avg((y - prediction) * (y - prediction)), 0) AS mse,
             round(sqrt(avg((y - prediction) * (y - prediction))), 4) AS rmse,
             round(1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)), 7) AS r2
      FROM predicted WHERE NOT train""",
}
