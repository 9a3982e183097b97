import numpy as np
from pyspark.sql import functions as F

from featflow.operators import treeshap_sql
from featflow.operators.models import fit_pipeline
from featflow.operators.treeshap import Ensemble, Tree, ensemble_from_spark, shap_values
from featflow.operators.treeshap_sql import leaves, share_bytes, share_table, shap_values_sql
from tests.test_treeshap import _node, _random_tree, brute_force

FEATS = ["l_quantity", "l_discount", "l_tax"]
IDS = ["l_orderkey", "l_linenumber"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fitted_models_equal_the_walk(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    for kind, kw in (("dt", {"maxDepth": 6}), ("rf", {"numTrees": 4, "maxDepth": 4}),
                     ("gbt", {"maxIter": 4, "maxDepth": 3})):
        ens = ensemble_from_spark(spark, fit_pipeline(li, FEATS, "l_extendedprice", kind, **kw),
                                  FEATS)
        ids = [*IDS, *FEATS]  # the key alone is not unique in this table
        got = shap_values_sql(li, ens, FEATS, ids, prefix="p_")
        plan = _plan(got)
        assert "Python" not in plan and "MapInPandas" not in plan and "Arrow" not in plan
        assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
        a = got.orderBy(*ids).toPandas()
        b = shap_values(li, ens, FEATS, ids, dtype="double", prefix="p_").orderBy(*ids).toPandas()
        assert list(a.columns) == list(b.columns) and len(a) == li.count()
        # 1e-9 of the largest share; shares are prices here.
        off = np.abs(a.to_numpy(float) - b.to_numpy(float)).max()
        assert off <= 1e-9 * np.abs(b[["p_" + f for f in FEATS]].to_numpy()).max()


def test_random_trees_equal_brute_force(spark):
    rng = np.random.default_rng(11)
    for depth, features in ((3, 2), (5, 5), (7, 3)):
        names = [f"f{i}" for i in range(features)]
        ens = Ensemble([_random_tree(rng, depth, features, 0.9) for _ in range(2)], [0.5, 2.0],
                       names)
        X = rng.normal(size=(4, features))
        df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], ["id", *names])
        for r in shap_values_sql(df, ens, names, ["id"]).collect():
            assert np.allclose([r[c] for c in names], brute_force(ens, X[r["id"]]), atol=1e-10)


def test_thresholds_repeats_nulls_and_ids(spark):
    nodes = [_node(0, 0, 5.0, 1, 2, 0, 10), _node(1, 0, 2.0, 3, 4, 0, 6),
             _node(2, 1, 1.0, 5, 6, 0, 4), _node(3, -1, 0, -1, -1, 1.0, 2),
             _node(4, -1, 0, -1, -1, 3.0, 4), _node(5, -1, 0, -1, -1, 10.0, 0),
             _node(6, -1, 0, -1, -1, -2.0, 4)]
    ens = Ensemble([Tree.from_nodes(nodes)], [1.0], ["entry", "x0"])
    inf = float("inf")
    rows = [("a", 5.0, 1.0), ("a", 5.0, 1.0), ("a", 5.0, 2.0), (None, 2.0, 1.0), (None, 2.0, 1.0),
            ("b", inf, -inf), ("b", -inf, inf), ("c", None, 1.0), ("d", 1.0, float("nan"))]
    df = spark.createDataFrame(rows, "leaf string, entry double, x0 double")
    for ids in (["leaf"], [], ["leaf", "entry"]):
        def rounded(out):
            return sorted(repr([x if isinstance(x, str) or x is None else round(x, 9) + 0.0
                                for x in r]) for r in out.collect())
        got = shap_values_sql(df, ens, id_cols=ids, prefix="phi_")
        assert rounded(got) == rounded(shap_values(df, ens, id_cols=ids, dtype="double",
                                                   prefix="phi_")), ids
    assert shap_values_sql(df.limit(0), ens, id_cols=["leaf"]).count() == 0
    single = Ensemble([Tree.from_nodes([_node(0, -1, 0, -1, -1, 7.0, 10)])], [1.0], ["entry"])
    assert [tuple(r) for r in shap_values_sql(df.limit(1), single).collect()] == [(7.0, 0.0)]


def test_size_is_known_beforehand_and_bounds_the_table(spark):
    rng = np.random.default_rng(2)
    names = [f"f{i}" for i in range(9)]
    ens = Ensemble([_random_tree(rng, 9, 9, 0.95)], [1.0], names)
    found = leaves(ens)
    table, starts = share_table(found, 9)
    assert share_bytes(found, 9) == len(table) * 80 and len(starts) == len(found)
    # Over the whole tree the masks of a row pick its prediction's leaf once.
    df = spark.createDataFrame([tuple(map(float, x)) for x in rng.normal(size=(5, 9))], names)
    beyond = shap_values_sql(df, ens, names, names[:1], max_bytes=100)
    assert "MapInPandas" in _plan(beyond)  # the walk, whatever the size
    inside = shap_values_sql(df, ens, names, prefix="p_")
    total = inside.select((F.col("expected_value")
                           + sum(F.col("p_" + c) for c in names)).alias("t"))
    want = sorted(ens.predict(np.array([list(r) for r in df.collect()])))
    assert np.allclose(sorted(r.t for r in total.collect()), want, atol=1e-9)
    assert treeshap_sql.MAX_SHARE_BYTES <= 64 << 20
